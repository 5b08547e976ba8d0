"""Substring dedup with compressed FM-indexes, one per shard.

A window is 13 consecutive words. A word is removed if a window that covers it also starts in a
document with a smaller id.

1. Anchors. Each window is represented by its minimizer: the 5-word gram with the least hash. Equal
   windows have equal minimizers, so a window can only repeat if its anchor does. Anchors (about one
   in five positions) are counted; those seen under one id only are dropped.
2. Segments. Around every anchor that is left, the run of windows it stands for (21 words at most) is
   cut out of the documents and dealt to shards by anchor. Equal segments collapse to one with the
   smallest id (partial aggregation), so thousands of copies reach a shard as one row. An anchor with
   more than ``HOT`` occurrences is dealt on by window: its segments are cut into single windows, salted by
   their content, so equal ones still meet.
3. FM-index. A shard concatenates the segments that can be a source (some segment of their anchor has a greater id),
   sorts their suffixes, and keeps the Burrows-Wheeler transform as a wavelet matrix of packed bits with
   sampled ranks, and the LCP of neighbouring suffixes. The segments that can repeat something (some segment of their anchor
   has a lesser id) are streamed against it, each once from its end, all side by side: backward search extends the match by a
   word, and a word that does not fit shortens the match from the right. Positions whose matching statistic reaches 13 words
   are windows found; the least id over the range of such a match is the window's first document.
4. Members of each segment get back its windows' first ids; windows first seen under a smaller id mark
   their words, and the documents are written without them.

Words travel as 64-bit hashes. Shards hold about ``SHARD`` words whatever the input's size; documents are
never compared pairwise. Workers treat ``SLICE`` words (or one document) at a time.

Defined cases: null or wordless texts keep nothing and lose nothing; texts shorter than a window stay
whole; repeated rows of one id do not count against each other; a row without id is neither changed
nor a source; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SQL_GAP, cut_lineage, forget, free_name, release
from .periodic_runs import _nearest_smaller

WINDOW = 13
GRAM = 5
HOT = 20_000
SHARD = 200_000
SLICE = 200_000
ROWS_AT_ONCE = 500


# ---- anchors --------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(words: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Minimizer runs of a flat array of word hashes whose documents start at ``offsets`` (one more at the
    end): arrays (document, first window, last window, anchor hash), windows counted from the document's start."""
    n = len(words)
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    if n < window:
        return empty
    g = np.zeros(n - gram + 1, dtype=np.uint64)
    for j in range(gram):
        g = _mix(g + words[j:n - gram + 1 + j] + np.uint64(0x9E3779B97F4A7C15 + 2 * j))
    span = window - gram + 1
    m = len(g) - span + 1
    least, at = g[:m].copy(), np.zeros(m, dtype=np.int8 if span <= 128 else np.int32)
    for j in range(1, span):  # the leftmost least gram of each window
        c = g[j:j + m]
        less = c < least
        np.copyto(least, c, where=less)
        at[less] = j
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = np.flatnonzero(doc[:m] == doc[window - 1:window - 1 + m])
    if not len(ok):
        return empty
    pos, d = ok + at[ok], doc[ok]
    new = np.empty(len(ok), dtype=bool)
    new[0] = True
    new[1:] = (pos[1:] != pos[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ok)) - 1
    d = d[first]
    return d, ok[first] - offsets[d], ok[last] - offsets[d], g[pos[first]]


def _flat(column):
    """(values, offsets) of an Arrow list column without nulls, as numpy."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = col.offsets.to_numpy().astype(np.int64)
    values = col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64).view(np.uint64)
    return values, off - off[0]


def _bounded(batches, most: int = SLICE):
    """The batches in slices of rows that hold about ``most`` words together (one row at least), so that a worker's memory
    does not follow the number of rows Spark puts in a batch."""
    for b in batches:
        total = b.column("w").offsets.to_numpy().astype(np.int64)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
            yield b.slice(i, j - i)
            i = j


def words_hash_sql(text: str) -> str:
    return f"transform(array_remove(split(coalesce({text}, ''), '{SQL_GAP}'), ''), w -> xxhash64(w))"


def length_bits(window: int) -> int:
    """Bits that hold a run's length, window - GRAM at most."""
    return max(4, (window - GRAM).bit_length())


# Place of a run in its row: 30 bits of a text hash (rows of one id may differ), 33 of the first window and the length.
def _pack(th, a, n, bits):
    if len(a) and (int(a.max()) >> (33 - bits) or int(n.max()) >> bits):
        raise ValueError(f"a place beyond {33 - bits} bits of a document's words or {bits} bits of a run")
    return th << 33 | a << bits | n


# ---- FM-index -------------------------------------------------------------------------------

class WaveletMatrix:
    """Rank queries over a sequence of small integers: one packed bit plane per bit, with the number of
    ones before each 64-bit block."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.planes, self.n = [], len(seq)
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            b = (seq >> bit & 1).astype(np.uint8)
            padded = np.zeros((len(seq) // 64 + 1) * 64, dtype=np.uint8)
            padded[:len(b)] = b
            blocks = np.packbits(padded, bitorder="little").view("<u8")
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks))[:-1]]).astype(np.int64)
            zeros = int(len(b) - b.sum())
            self.planes.append((bit, blocks, ranks, zeros))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``c[k]`` before position ``i[k]``, relative to the start of c's run in the last plane; the
        difference of two such ranks counts occurrences between them."""
        for bit, blocks, ranks, zeros in self.planes:
            k = i >> 6
            ones = ranks[k] + np.bitwise_count(blocks[k] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where(c >> bit & 1 == 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Backward search over the concatenation of word sequences (separated, so no match spans two)."""

    def __init__(self, texts: np.ndarray, lengths: np.ndarray, depth: int):
        """``texts``: all sequences end to end, as ints >= 1; ``depth``: suffixes are told apart up to that many words."""
        n_texts = len(lengths)
        owner = np.repeat(np.arange(n_texts), lengths + 1)
        t = np.zeros(len(texts) + n_texts, dtype=np.int64)
        t[np.arange(len(texts)) + np.repeat(np.arange(n_texts), lengths)] = texts
        sigma = int(t.max()) + 1 if len(t) else 1
        # prefix doubling: rank by the first k words, then 2k, until depth is reached
        rank, k = t.copy(), 1
        levels = [np.append(rank, -1).astype(np.int32)]
        order = np.argsort(rank, kind="stable")
        while k < depth:
            nxt = np.zeros(len(t), dtype=np.int64)
            nxt[:-k] = rank[k:] + 1
            key = rank * (int(rank.max()) + 3) + nxt
            order = np.argsort(key, kind="stable")
            s = key[order]
            new = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
            rank = np.empty_like(rank)
            rank[order] = new
            levels.append(np.append(rank, -1).astype(np.int32))
            k *= 2
        self.depth = depth
        self.owner = owner[order]
        bwt = t[order - 1]  # position 0 wraps to the last separator
        self.wm = WaveletMatrix(bwt, sigma)
        counts = np.bincount(t, minlength=sigma + 1)
        self.start = np.concatenate([[0], np.cumsum(counts)])
        # where c's run begins in the last plane, so ranks become absolute
        symbols = np.arange(sigma)
        self.base = self.wm.rank(symbols, np.zeros(sigma, dtype=np.int64))
        self.n = len(t)
        # common words of neighbours in suffix order, and for each boundary the nearest ones of fewer common words
        self.lcp = np.full(self.n + 1, -1, dtype=np.int32)
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(self.n - 1, dtype=np.int32)
        for j in range(len(levels) - 1, -1, -1):
            same = levels[j][np.minimum(x, self.n)] == levels[j][np.minimum(y, self.n)]
            common[same] += 1 << j
            x[same] += 1 << j
            y[same] += 1 << j
        self.lcp[1:-1] = common
        del levels, x, y, common
        inner = np.flatnonzero(self.lcp > 0)
        self.less_before, self.less_behind = np.zeros(self.n + 1, np.int32), np.zeros(self.n + 1, np.int32)
        self.less_before[inner] = _nearest_smaller(self.lcp, inner, -1)
        self.less_behind[inner] = _nearest_smaller(self.lcp, inner, 1)

    def _widen(self, lo, hi):
        """The ranges around [lo, hi) of the longest shorter prefix that more suffixes share, and its number of words."""
        left, right = self.lcp[lo], self.lcp[hi]
        words = np.maximum(left, right)
        whole = words <= 0
        wide = np.where(whole, 0, np.where(left == words, self.less_before[lo], lo))
        behind = np.where(whole, self.n, np.where(right == words, self.less_behind[hi], hi))
        return wide, behind, np.maximum(words, 0)

    def stream(self, words: np.ndarray, lengths: np.ndarray):
        """Matching statistics of word sequences (``words``: end to end, ints, 0 for a word that the index does not hold):
        for each position the number of words from there on, ``depth`` at most, that occur in the index, and the suffix range
        of that match. Each sequence is read once from its end: a word that does not extend the match shortens it from
        the right until it does, so no position starts anew."""
        matched = np.zeros(len(words), dtype=np.int64)
        low, high = np.zeros(len(words), dtype=np.int64), np.full(len(words), self.n)
        at = np.cumsum(lengths) - 1
        lo, hi, ell = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero(lengths > back)
            pos = at[live] - back
            full = live[ell[live] == self.depth]  # room for one more word: the last one goes
            if len(full):
                wide, behind, words_left = self._widen(lo[full], hi[full])
                keep = words_left == self.depth - 1
                lo[full] = np.where(keep, wide, lo[full])
                hi[full] = np.where(keep, behind, hi[full])
                ell[full] = self.depth - 1
            todo = live[words[pos] > 0]
            gone = live[words[pos] <= 0]
            lo[gone], hi[gone], ell[gone] = 0, self.n, 0
            while len(todo):
                c = words[at[todo] - back]
                b = self.start[c] - self.base[c]
                l2 = b + self.wm.rank(c, lo[todo])
                h2 = b + self.wm.rank(c, hi[todo])
                ok = l2 < h2
                fit = todo[ok]
                lo[fit], hi[fit] = l2[ok], h2[ok]
                ell[fit] += 1
                todo = todo[~ok]
                todo = todo[ell[todo] > 0]
                lo[todo], hi[todo], ell[todo] = self._widen(lo[todo], hi[todo])
            matched[pos], low[pos], high[pos] = ell[live], lo[live], hi[live]
        return matched, low, high


def first_ids(words: np.ndarray, lengths: np.ndarray, ids: np.ndarray, groups: np.ndarray, window: int = WINDOW):
    """For every window of every word sequence (``words``: all of them end to end): the least id among the sequences that hold
    the window. Equal windows lie in sequences of one group. Sequences that can be a source, those with a greater id in their
    group, are indexed once; sequences that can repeat one, those with a lesser id in their group, are streamed against the index.
    Returns (firsts, number of windows of each sequence)."""
    n_win = np.maximum(lengths - window + 1, 0)
    begin = np.cumsum(lengths) - lengths
    firsts = np.repeat(ids, n_win)  # a window is held by its own sequence at least
    _, g = np.unique(groups, return_inverse=True)
    g = g.reshape(-1)
    lo, hi = np.full(g.max(initial=-1) + 1, np.iinfo(np.int64).max), np.full(g.max(initial=-1) + 1, np.iinfo(np.int64).min)
    np.minimum.at(lo, g, ids)
    np.maximum.at(hi, g, ids)
    source, asks = np.flatnonzero(ids < hi[g]), np.flatnonzero(ids > lo[g])
    if not len(source):
        return firsts, n_win

    def texts(which):
        size = lengths[which]
        return np.arange(int(size.sum())) + np.repeat(begin[which] - (np.cumsum(size) - size), size), size

    held, held_size = texts(source)
    symbols, flat = np.unique(words[held], return_inverse=True)
    index = FMIndex(flat.reshape(-1).astype(np.int64) + 1, held_size, window)
    asked, size = texts(asks)
    code = np.minimum(np.searchsorted(symbols, words[asked]), len(symbols) - 1)
    matched, low, high = index.stream(np.where(symbols[code] == words[asked], code + 1, 0), size)
    full = np.flatnonzero(matched == window)
    if len(full):
        ranges, which = np.unique(low[full], return_index=True)  # ranges of different windows are disjoint
        cuts = np.stack([ranges, high[full][which]], axis=1).reshape(-1)
        least = np.minimum.reduceat(np.append(ids[source][index.owner], np.iinfo(np.int64).max), cuts)[::2]
        owner = np.repeat(np.arange(len(asks)), size)[full]
        start = full - (np.cumsum(size) - size)[owner]
        slot = (np.cumsum(n_win) - n_win)[asks[owner]] + start
        firsts[slot] = np.minimum(firsts[slot], least[np.searchsorted(ranges, low[full])])
    return firsts, n_win


# ---- the operator ---------------------------------------------------------------------------

def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        forget()
        for b in _bounded(batches):
            values, off = _flat(b.column("w"))
            d, a, z, g = anchors(values, off, window)
            if len(d):
                ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                th = b.column("th").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(ids[d]), pa.array(_pack(th[d], a, z - a, length_bits(window)))],
                                                 names=["gram", "id", "place"])

    return docs.mapInArrow(run, "gram long, id long, place long")


def _structs(column, names):
    """Fields of an Arrow list<struct> column as flat arrays, and the row each belongs to."""
    off = column.offsets.to_numpy().astype(np.int64)
    items = column.values.slice(off[0], off[-1] - off[0])
    row = np.repeat(np.arange(len(column)), np.diff(off))
    return [items.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names], row


def _place(place, bits):
    """(text hash, first window, windows - 1) of packed places."""
    return place >> 33, place >> bits & ((1 << 33 - bits) - 1), place & ((1 << bits) - 1)


def _content_hash(values, starts, lengths):
    h = lengths.astype(np.uint64)
    for j in range(int(lengths.max(initial=0))):
        live = lengths > j
        word = values[np.where(live, starts + j, 0)]
        h = np.where(live, _mix(h + word + np.uint64(0x9E3779B97F4A7C15)), h)
    return h


def _member_rows(joined: DataFrame, window: int) -> DataFrame:
    """Each document's segments as hashes; a hot anchor's segments are cut into windows, salted by content."""
    def run(batches):
        for b in _bounded(batches):
            values, off = _flat(b.column("w"))
            (gram, place, split), row = _structs(b.column("places"), ("gram", "place", "split"))
            th, a, n = _place(place, length_bits(window))
            ok = th == b.column("th").to_numpy(zero_copy_only=False).astype(np.int64)[row]  # rows of one id may differ
            gram, split, row, th, a, n = (x[ok] for x in (gram, split, row, th, a, n))
            times = np.where(split > 1, n + 1, 1)
            k = np.repeat(np.arange(len(times)), times)
            step = np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times)
            hot = split[k] > 1
            gram, row, th, split, a, n = gram[k], row[k], th[k], split[k], a[k] + step, np.where(hot, 0, n[k])
            if not len(gram):
                continue
            h = _content_hash(values, off[row] + a, n + window)
            salt = np.where(hot, (h % np.maximum(split, 1).astype(np.uint64)).astype(np.int64), 0)
            ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)[row]
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(salt.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(ids),
                                              pa.array(_pack(th, a, n, length_bits(window)))], names=["gram", "salt", "chash", "id", "place"])

    return joined.mapInArrow(run, "gram long, salt int, chash long, id long, place long")


def _content_rows(joined: DataFrame, window: int) -> DataFrame:
    """The words of each distinct segment, cut out of the document that stands for it."""
    names = ("gram", "salt", "chash", "place", "n")

    def run(batches):
        for b in _bounded(batches):
            values, off = _flat(b.column("w"))
            (gram, salt, chash, place, count), row = _structs(b.column("reps"), names)
            th, a, n = _place(place, length_bits(window))
            ok = th == b.column("th").to_numpy(zero_copy_only=False).astype(np.int64)[row]
            gram, salt, chash, count, row, a, n = (x[ok] for x in (gram, salt, chash, count, row, a, n))
            lengths = n + window
            ends = np.cumsum(lengths)
            at = np.arange(int(lengths.sum())) + np.repeat(off[row] + a - (ends - lengths), lengths)
            cuts = np.concatenate([[0], 8 * ends])
            for i in range(0, len(gram), 20_000):
                j = min(i + 20_000, len(gram))
                data = values[at[cuts[i] // 8:cuts[j] // 8]]
                content = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((cuts[i:j + 1] - cuts[i]).astype(np.int32)),
                                                                    pa.py_buffer(np.ascontiguousarray(data))])
                ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)[row[i:j]]
                yield pa.RecordBatch.from_arrays([pa.array(gram[i:j]), pa.array(salt[i:j].astype(np.int32)), pa.array(chash[i:j]),
                                                  pa.array(ids), pa.array(count[i:j]), content],
                                                 names=["gram", "salt", "chash", "least", "n", "content"])

    return joined.mapInArrow(run, "gram long, salt int, chash long, least long, n long, content binary")


def _first_rows(dealt: DataFrame, window: int) -> DataFrame:
    """Each shard (a run of rows with one shard number) is indexed and searched once."""
    def solve(parts):
        gram, salt, chash, least, n, lengths = (np.concatenate([p[i] for p in parts]) for i in range(6))
        words = np.concatenate([p[6] for p in parts])
        groups = _mix(gram.view(np.uint64) + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        firsts, n_win = first_ids(words, lengths, least, groups, window)
        # a segment of one document whose windows start nowhere earlier has nothing to report
        earlier = np.bincount(np.repeat(np.arange(len(n_win)), n_win), firsts < np.repeat(least, n_win), minlength=len(n_win)) > 0
        keep = (n > 1) | earlier
        if keep.any():
            kept = np.repeat(keep, n_win)
            offsets = np.concatenate([[0], np.cumsum(n_win[keep])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[keep]), pa.array(salt[keep].astype(np.int32)), pa.array(chash[keep]),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(firsts[kept]))], names=["gram", "salt", "chash", "firsts"])

    def run(batches):
        forget()
        held, shard = [], None
        for b in batches:
            number = b.column("shard").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(number)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(number)]):
                if i == j:
                    continue
                if number[i] != shard:
                    if held:
                        yield from solve(held)
                    held, shard = [], number[i]
                part = b.slice(i, j - i)
                content = part.column("content").cast(pa.large_binary())
                off = np.frombuffer(content.buffers()[1], np.int64)[content.offset:content.offset + len(content) + 1]
                words = np.frombuffer(content.buffers()[2], np.uint8)[off[0]:off[-1]].copy().view(np.uint64)
                held.append([part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in ("gram", "salt", "chash", "least", "n")] + [np.diff(off) // 8, words])
        if held:
            yield from solve(held)

    return dealt.mapInArrow(run, "gram long, salt int, chash long, firsts array<long>")


def repeated_windows(df: DataFrame, id_col: str, text: str, window: int = WINDOW, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(id, th, starts): for each document the starts of windows that also start under a smaller id. Each
    step is written before the next; what no later step reads is deleted, so disk holds two steps."""
    bits = length_bits(window)
    quoted, qid = "`" + text.replace("`", "``") + "`", F.col(id_col).cast("long")
    docs = (df.where(F.col(id_col).isNotNull()).select(
        qid.alias("id"), F.expr(f"xxhash64({quoted}) & 1073741823L").alias("th"), F.col(text).alias("t")))
    hashed = ["id", "th", F.expr(words_hash_sql("t")).alias("w")]
    found = cut_lineage(_anchor_rows(docs.select(*hashed), window))
    shared = cut_lineage(found.groupBy("gram").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count(F.lit(1)).alias("n"))
                         .where("a < z").select("gram", F.expr(f"CAST(ceil(n / {hot}) AS INT)").alias("split")))
    places = cut_lineage(found.join(shared, "gram").groupBy("id").agg(
        F.collect_list(F.struct("gram", "place", "split")).alias("places")))
    release(found)
    members = cut_lineage(_member_rows(docs.join(places, "id").select(*hashed, "places"), window))
    release(places)
    unique = members.groupBy("gram", "salt", "chash").agg(F.min(F.struct("id", "place")).alias("r"), F.count(F.lit(1)).alias("n"))
    reps = cut_lineage(unique.groupBy(F.col("r.id").alias("id")).agg(
        F.collect_list(F.struct("gram", "salt", "chash", "r.place", "n")).alias("reps")))
    words = reps.agg(F.sum(F.expr(f"aggregate(reps, 0L, (a, x) -> a + (x.place & {(1 << bits) - 1}) + {window})"))).first()[0] or 0
    shards = max(1, -(-words // shard))
    contents = _content_rows(docs.join(reps, "id").select(*hashed, "reps"), window)
    dealt = (contents.withColumn("shard", F.pmod(F.xxhash64("gram", "salt"), F.lit(shards)).cast("long"))
             .repartition(shards, "shard").sortWithinPartitions("shard"))
    firsts = cut_lineage(_first_rows(dealt, window))
    release(reps)
    late = members.join(firsts, ["gram", "salt", "chash"]).select(
        "id", F.expr("place >> 33").alias("th"), F.expr(
            f"filter(transform(firsts, (f, i) -> CASE WHEN f < id THEN CAST((place >> {bits}) & {(1 << 33 - bits) - 1} AS INT) + i END), x -> x IS NOT NULL)"
        ).alias("s")).where("size(s) > 0")
    starts = cut_lineage(late.groupBy("id", "th").agg(F.flatten(F.collect_list("s")).alias("starts")))
    release(members)
    return starts


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT,
                   shard: int = SHARD) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space), under the next free names."""
    starts = repeated_windows(df, id_col, text, window, hot, shard)
    names = [free_name(df, n) for n in ("n_words", "n_removed", "kept_text")]
    quoted = "`" + text.replace("`", "``") + "`"
    right = starts.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("starts").alias("__starts"))
    joined = df.join(right, (F.col(id_col).cast("long") == F.col("__id"))
                     & (F.expr(f"xxhash64({quoted}) & 1073741823L") == F.col("__th")), "left").drop("__id", "__th")
    cols = df.columns
    schema = joined.select(*cols, F.lit(0).cast("long").alias(names[0]), F.lit(0).cast("long").alias(names[1]),
                           F.lit("").alias(names[2])).schema
    at, at_starts, out_names = cols.index(text), len(cols), cols + names

    def run(batches):
        for b in (whole.slice(i, ROWS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, ROWS_AT_ONCE)):
            total, gone, kept = [], [], []
            for t, s in zip(b.column(at).to_pylist(), b.column(at_starts).to_pylist()):
                w = (t or "").encode().split()
                n = len(w)
                if s:
                    edge = np.zeros(n + 1, dtype=np.int64)  # +1 where a window starts, -1 after its end
                    u = np.unique(np.asarray(s, dtype=np.int64))
                    edge[u] += 1
                    edge[u + window] -= 1
                    covered = np.cumsum(edge)[:n] > 0
                    w = [x for x, c in zip(w, covered.tolist()) if not c]
                total.append(n)
                gone.append(n - len(w))
                kept.append(b" ".join(w).decode())
            yield pa.RecordBatch.from_arrays([*b.columns[:at_starts], pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string())], names=out_names)

    return joined.mapInArrow(run, schema)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with its texts rewritten: documents that lost words keep the rest, joined by one space; the
    others keep their text as it is. ``n_chars``, if there, follows the text."""
    out = remove_repeats(df, id_col, text, window)
    removed, kept = out.columns[-2:]
    new = F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col(text))
    cols = []
    for c in df.columns:
        if c == text:
            cols.append(new.alias(c))
        elif c == "n_chars" and text == "text":
            cols.append(F.when(F.col(removed) > 0, F.length(kept).cast("long")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
