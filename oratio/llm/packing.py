"""Lexical retrieval packing: BM25 neighbours of a seed document greedily fill its window.

Documents are tokenized and closed by an end id. A document's full windows of ``WINDOW`` ids are sequences of
their own; what is left over (less than a window) is packed with lexically near remainders:
remainders are range-partitioned by a min-hash of their ids, so near texts come to the same shard of
``SHARD`` remainders. Each shard builds an inverted index (postings of id -> remainder, BM25 weight,
document frequencies and mean length of the whole corpus). The longest unused remainder is the
seed; its ids query the index, and the unused neighbours fill the window best first; the last one is
cut to fit and its rest goes back to the pool. A window that a shard cannot fill is handed to the
next shard of the task; the last one of a task is cut into sequences of power-of-two lengths, which
need no padding. So no sequence is padded at all, at the price of at most eleven short ones a task.

Scale: full windows never move; remainders are shuffled once. Ranges hold about equal numbers of
remainders, and ties of the min-hash (copies) are split by a hash of the id, so a large group of copies is
dealt over many shards. Document frequencies are summed per task and bounded by the vocabulary. A
task holds one shard.

Defined cases: a null text is empty (its end id is packed like any other); repeated rows are
documents of their own; a null id is carried along; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .tokens import TextEncoder

WINDOW = 2048
SHARD = 4096
K1, B = 1.2, 0.75
DENSE = 512    # ids of a shard whose postings are rows of a matrix (16 MB)
SPARSE = 32    # if at least one remainder in so many holds them
STRIP = 16     # remainders a product takes: small enough to stay on the one core of a task
AHEAD = 32     # seeds whose common ids are scored together

CUT = "kind int, doc_id long, start long, ids binary, doc_tokens long, key long, sequence_id long"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
FULL, REST, STATS = 0, 1, 2
# Sequence ids: the task in the upper bits, a counter below; full windows carry one more bit.
FULL_BIT = 1 << 62


def _permutation(size: int) -> np.ndarray:
    """A fixed 32-bit hash of each id."""
    x = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def tokenize_cut(df: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str, window: int) -> DataFrame:
    """Rows (schema ``CUT``): full windows, remainders with their locality key, and one row per task with
    document frequencies (pairs id, count), number of documents and of ids."""
    from pyspark import TaskContext

    def run(batches):
        enc = TextEncoder(tokenizer)
        size = enc.tok.get_vocab_size() + 1
        perm = _permutation(max(size, end_id + 1))
        df_counts, place = np.zeros(len(perm), np.int32), np.zeros(len(perm), np.int64)
        n_docs = n_ids = number = 0
        base = FULL_BIT | TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in CUT.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            docs, texts = b.column("id").to_pylist(), b.column("t")
            for a in range(0, len(docs), 2000):
                rows = []
                for d, raw in zip(docs[a:a + 2000], enc(texts.slice(a, 2000).to_pylist())):
                    ids = np.append(np.frombuffer(raw, enc.dtype), enc.dtype.type(end_id))
                    n = len(ids)
                    at = np.arange(n)
                    place[ids] = at  # the last place of each id stays
                    df_counts[ids[place[ids] == at]] += 1
                    n_docs += 1
                    n_ids += n
                    whole = n // window * window
                    for s in range(0, whole, window):
                        rows.append((FULL, d, s, ids[s:s + window].tobytes(), n, None, base | number))
                        number += 1
                    if whole < n:
                        rest = ids[whole:]
                        rows.append((REST, d, whole, rest.tobytes(), n, int(perm[rest].min()), None))
                if rows:
                    yield batch(rows)
        if n_docs:
            at = np.flatnonzero(df_counts)
            pairs = np.stack([at, df_counts[at]], axis=1).astype("<i8")
            yield batch([(STATS, n_docs, n_ids, pairs.tobytes(), 0, None, None)])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, CUT)


def corpus_stats(cut: DataFrame) -> tuple[np.ndarray, int, float]:
    """(document frequency by id, documents, mean length) summed over the task rows."""
    def run(batches):
        for b in batches:
            for raw in b.column("ids").to_pylist():
                p = np.frombuffer(raw, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["id", "n"])

    stats = cut.where(F.col("kind") == STATS)
    rows = stats.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = stats.agg(F.sum("doc_id").alias("docs"), F.sum("start").alias("ids")).first()
    out = np.zeros(max([r.id for r in rows], default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    docs = total.docs or 0
    return out, docs, (total.ids / docs if docs else 1.0)


def distinct(ids: np.ndarray) -> np.ndarray:
    s = np.sort(ids)
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


class Index:
    """Inverted index of one shard with BM25 weights: postings sorted by id, the longest ones (at most ``DENSE``) as rows of a
    matrix, so that the common ids of several queries are scored by one product."""

    def __init__(self, pieces: list[np.ndarray], df: np.ndarray, docs: int, mean: float):
        n = len(pieces)
        lengths, bits = np.array([len(p) for p in pieces]), n.bit_length()
        both = np.concatenate(pieces).astype(np.int64) << bits | np.repeat(np.arange(n), lengths)
        both.sort()  # by id, then remainder
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        tf = np.diff(np.append(first, len(both)))
        ids, self.doc = both[first] >> bits, both[first] & (1 << bits) - 1
        idf = np.log1p((docs - df[ids] + 0.5) / (df[ids] + 0.5))
        self.weight = idf * tf * (K1 + 1) / (tf + (K1 * (1 - B + B * lengths / mean))[self.doc])
        held = np.bincount(ids, minlength=len(df))
        long = np.argsort(-held, kind="stable")[:DENSE]
        long = long[held[long] * SPARSE >= max(n, SPARSE)]
        self.row = np.full(len(df), -1)
        self.row[long] = np.arange(len(long))
        self.columns = np.arange(n)  # the remainders that the matrix holds
        self.dense = np.zeros((len(long), n), np.float32)
        in_dense = self.row[ids] >= 0
        self.dense[self.row[ids[in_dense]], self.doc[in_dense]] = self.weight[in_dense]
        self.doc, self.weight = self.doc[~in_dense], self.weight[~in_dense]
        self.first = np.searchsorted(ids[~in_dense], np.arange(len(df) + 1))
        self.n = self.live = n

    def drop_used(self, unused: np.ndarray) -> None:
        """Postings of used remainders go once they are an eighth of those indexed; scores of the others stay the same."""
        left = int(np.count_nonzero(unused))
        if left * 8 <= self.live * 7:
            keep = unused[self.doc]
            before = np.concatenate([[0], np.cumsum(keep)])
            self.doc, self.weight, self.first, self.live = self.doc[keep], self.weight[keep], before[self.first], left
            keep = unused[self.columns]
            self.columns, self.dense = self.columns[keep], np.ascontiguousarray(self.dense[:, keep])

    def common(self, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(remainders, a row a query of their scores by the ids in the matrix)."""
        asked = np.zeros((len(queries), len(self.dense)), np.float32)
        for i, q in enumerate(queries):
            rows = self.row[q]
            asked[i, rows[rows >= 0]] = 1
        out = np.empty((len(queries), len(self.columns)), np.float32)
        for a in range(0, len(self.columns), STRIP):
            np.matmul(asked, self.dense[:, a:a + STRIP], out=out[:, a:a + STRIP])
        return self.columns, out

    def scores(self, query: np.ndarray, common=None) -> np.ndarray:
        """BM25 of every remainder in the postings for the distinct ids of ``query``. ``common``: what ``common`` gave
        for it, now or before remainders were dropped."""
        if common is None:
            columns, parts = self.common([query])
            common = columns, parts[0]
        spans = [(i, j) for i, j in zip(self.first[query].tolist(), self.first[query + 1].tolist()) if i < j]
        if spans:
            out = np.bincount(np.concatenate([self.doc[i:j] for i, j in spans]),
                              np.concatenate([self.weight[i:j] for i, j in spans]), minlength=self.n)
        else:
            out = np.zeros(self.n)
        out[common[0]] += common[1]
        return out


def best_first(score: np.ndarray, some: int = 32):
    """Positions by falling score, ties by position; only as many are sorted as are asked for."""
    done, n = 0, len(score)
    while done < n:
        some = min(some, n)
        least = np.partition(score, n - some)[n - some]
        at = np.flatnonzero(score >= least)
        at = at[np.argsort(-score[at], kind="stable")]
        yield from at[done:].tolist()
        done, some = len(at), 8 * some


def pack_shard(rest: list, window: int, stats, carry: list):
    """Fill windows from one shard. ``rest``: [doc, start, ids, doc_tokens]; ``carry``: pieces of a window that the
    shard before could not fill. Yields full windows (lists of pieces); returns the pieces left."""
    df, docs, mean = stats
    index = Index([r[2] for r in rest], df, docs, mean)
    pool = [[r[1], r[2]] for r in rest]  # start and ids of what is unused
    unused = np.ones(len(rest), dtype=bool)
    longest, at = np.argsort([-len(r[2]) for r in rest], kind="stable").tolist(), 0
    known = {}  # seeds ahead: what the common ids of each give
    done = []
    while True:
        if carry:
            open_window, query, common = carry, distinct(carry[0][2]), None
        else:
            while at < len(longest) and not unused[longest[at]]:
                at += 1
            if at == len(longest):
                return done, []
            seed = longest[at]
            if seed not in known:
                index.drop_used(unused)
                ahead = [i for i in longest[at:at + 4 * AHEAD] if unused[i]][:AHEAD]
                columns, parts = index.common([rest[i][2] for i in ahead])
                known = {i: (columns, p) for i, p in zip(ahead, parts)}
            start, ids = pool[seed]
            unused[seed] = False
            open_window, query, common = [(rest[seed][0], start, ids, rest[seed][3])], distinct(rest[seed][2]), known[seed]
        carry = []
        space = window - sum(len(p[2]) for p in open_window)
        if space:
            index.drop_used(unused)
            score = np.where(unused, index.scores(query, common), -1.0)
            for j in best_first(score):
                if not unused[j] or not space:
                    break
                start, ids = pool[j]
                take = min(space, len(ids))
                open_window.append((rest[j][0], start, ids[:take], rest[j][3]))
                space -= take
                if take < len(ids):
                    pool[j] = [start + take, ids[take:]]
                else:
                    unused[j] = False
        if space:
            return done, open_window
        done.append(open_window)


def powers_of_two(pieces: list):
    """Cut the pieces of an unfilled window into sequences whose lengths are powers of two."""
    left = sum(len(p[2]) for p in pieces)
    pieces, out = list(pieces), []
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        seq = []
        while size:
            d, start, ids, n = pieces.pop(0)
            seq.append((d, start, ids[:size], n))
            if len(ids) > size:
                pieces.insert(0, (d, start + size, ids[size:], n))
            size -= min(size, len(ids))
        out.append(seq)
    return out


def pack(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text",
         window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """Pieces of all sequences (schema ``PIECES``); ``ids`` are little-endian uint32."""
    from pyspark import TaskContext

    cut = cut_lineage(tokenize_cut(df, tokenizer, end_id, id_col, text, window))
    stats = corpus_stats(cut)
    dtype = TextEncoder(tokenizer).dtype.str
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch(sequences):
        rows = []
        for number, pieces in sequences:
            at = 0
            for d, start, ids, total in pieces:
                rows.append((d, start, len(ids), ids.astype("<u4").tobytes(), total, number, at))
                at += len(ids)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        base, number, carry, rest = TaskContext.get().partitionId() << 32, 0, [], []

        def settle():
            nonlocal number, carry
            done, carry = pack_shard(rest, window, stats, carry)
            out = [(base | number + i, p) for i, p in enumerate(done)]
            number += len(done)
            return out

        for b in batches:
            for d, start, raw, total in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
                rest.append([d, start, np.frombuffer(raw, dtype), total])
                if len(rest) == shard:
                    out = settle()
                    rest = []
                    if out:
                        yield batch(out)
        out = settle() if rest else []
        tail = powers_of_two(carry)
        out += [(base | number + i, p) for i, p in enumerate(tail)]
        if out:
            yield batch(out)

    rests = cut.where(F.col("kind") == REST).withColumn("tie", F.xxhash64("doc_id", "start"))
    ranged = rests.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie", "doc_id", "start", "ids")
    packed = ranged.select("doc_id", "start", "ids", "doc_tokens").mapInArrow(run, PIECES)

    def widen(batches):
        for b in batches:
            ids = [np.frombuffer(x, dtype) for x in b.column("ids").to_pylist()]
            k = len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), b.column("doc_tokens"), b.column("sequence_id"),
                 pa.array([0] * k, pa.int64())], names=names)

    full = cut.where(F.col("kind") == FULL).mapInArrow(widen, PIECES)
    return full.unionAll(packed)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
