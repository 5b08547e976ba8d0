"""Token-id files: static range asymmetric numeral system (rANS) with interleaved lanes.

``write_token_file`` tokenizes documents in ascending id order and writes, under one folder,

* ``table``: one row, the frequency table that all blocks share (token counts of the whole corpus, scaled
  to 2**SCALE, at least 1 for each token that occurs),
* ``blocks``: Parquet rows, one per block: part and number (file order), ids and lengths of its documents, and the
  payload,
* ``starts``: the number of ids before each part.

A payload stands alone: header, checkpoints, words, checksum. Up to ``LANES`` states encode a block side by
side (token i belongs to lane i mod lanes) and share one stream of 32-bit words. Every
``CHECKPOINT`` steps a checkpoint holds all states, the place in the stream and a checksum of
the tokens up to the next one, so stretches of a block decode in parallel and damage is located.

Scale: one range shuffle by id; a task holds one block of about ``BLOCK`` tokens (a longer document is a
block of its own). Counts are summed per task before they are shuffled; the table is bounded by the
vocabulary, the list of part sizes by the number of partitions.

Defined cases: a null text is empty (end id only); documents sort by (id, text), nulls first, so
repeated rows have a fixed order; an empty table gives files without blocks and an empty result;
other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, ensure_checkpoint_dir
from .tokens import TextEncoder

SCALE = 20
LANES = 2048
CHECKPOINT = 256
BLOCK = 1 << 20
LOW = 1 << 31  # states stay at or above this between tokens
MAGIC = b"RANS"


# ---- codec ---------------------------------------------------------------------------------

def scaled_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 where the count is positive."""
    total = 1 << SCALE
    freq = np.zeros(len(counts), dtype=np.int64)
    used = counts > 0
    if not used.any():
        return freq
    if used.sum() > total:
        raise ValueError("more distinct tokens than slots; raise SCALE")
    share = counts[used].astype(np.float64) / counts.sum()
    freq[used] = np.maximum(1, np.floor(share * total).astype(np.int64))
    over = int(freq.sum()) - total
    for i in np.argsort(-freq, kind="stable"):  # the largest give or take the rounding
        if over <= 0:
            break
        give = min(over, int(freq[i]) - 1)
        freq[i] -= give
        over -= give
    freq[int(np.argmax(freq))] -= min(over, 0)
    return freq


def encode_block(ids: np.ndarray, freq: np.ndarray, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> bytes:
    ids = np.asarray(ids, dtype=np.int64)
    lanes = max(1, min(lanes, 1 << max(0, (len(ids) // 64).bit_length() - 1)))
    steps = -(-len(ids) // lanes)
    cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    f64 = freq.astype(np.uint64)
    pad = np.full(steps * lanes - len(ids), int(np.argmax(freq)), dtype=np.int64)
    grid = np.concatenate([ids, pad]).reshape(steps, lanes)
    x = np.full(lanes, LOW, dtype=np.uint64)
    words, marks = [], []
    sh, up, full = np.uint64(SCALE), np.uint64(63 - SCALE), np.uint64(32)
    for step in range(steps - 1, -1, -1):
        s = grid[step]
        f = f64[s]
        need = x >= (f << up)
        words.append(x[need].astype(np.uint32))  # the low 32 bits
        x = np.where(need, x >> full, x)
        q = x // f
        x = (q << sh) + (x - q * f) + cum[s]
        if step % checkpoint == 0:
            marks.append((step, x.copy()))
    words.reverse()
    before = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    out = [MAGIC, struct.pack("<IIII", len(ids), lanes, checkpoint, len(marks))]
    for step, state in reversed(marks):
        part = ids[step * lanes:(step + checkpoint) * lanes]
        out.append(struct.pack("<II", int(before[step]), zlib.crc32(part.astype("<u4").tobytes())))
        out.append(state.astype("<u8").tobytes())
    out.append(np.concatenate(words).astype("<u4").tobytes() if words else b"")
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


def decode_tables(freq: np.ndarray):
    cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    return np.repeat(np.arange(len(freq), dtype=np.int64), freq), freq.astype(np.uint64), cum


def decode_stretch(payload: bytes, k: int, tables) -> np.ndarray:
    """The tokens between checkpoint ``k`` and the next, from the checkpoint alone."""
    symbol, f64, cum = tables
    n, lanes, every, marks = struct.unpack_from("<IIII", payload, 4)
    head = 20 + k * (8 + 8 * lanes)
    at, crc = struct.unpack_from("<II", payload, head)
    x = np.frombuffer(payload, "<u8", lanes, head + 8).astype(np.uint64)
    stream = np.frombuffer(payload[20 + marks * (8 + 8 * lanes):-4], "<u4")
    steps = min(every, -(-n // lanes) - k * every)
    out = np.empty((steps, lanes), dtype=np.int64)
    mask, sh, full, low = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
    for step in range(steps):
        slot = x & mask
        s = symbol[slot.astype(np.int64)]
        out[step] = s
        x = f64[s] * (x >> sh) + slot - cum[s]
        need = np.flatnonzero(x < low)
        x[need] = (x[need] << full) | stream[at:at + len(need)].astype(np.uint64)
        at += len(need)
    ids = out.reshape(-1)[:n - k * every * lanes]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError(f"checkpoint {k}: tokens do not match their checksum")
    return ids


def decode_block(payload: bytes, tables) -> np.ndarray:
    if payload[:4] != MAGIC or zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("damaged block")
    marks = struct.unpack_from("<IIII", payload, 4)[3]
    return np.concatenate([decode_stretch(payload, k, tables) for k in range(marks)] or [np.empty(0, np.int64)])


# ---- files ---------------------------------------------------------------------------------

CHUNKS = "part int, block int, doc_ids array<long>, lengths array<int>, ids binary, n_tokens long"


def tokenize_sorted(df: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str, block: int = BLOCK) -> DataFrame:
    """Chunks of whole documents in id order: parts are ranges of ids, blocks count up within a part."""
    from pyspark import TaskContext

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    dealt = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "t")

    def run(batches):
        enc = TextEncoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        width, part, number = enc.dtype.itemsize, TaskContext.get().partitionId(), 0
        docs, lens, buf, held = [], [], [], 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                                               pa.array([docs], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int32())),
                                               pa.array([b"".join(buf)], pa.binary()), pa.array([sum(lens)], pa.int64())],
                                              names=["part", "block", "doc_ids", "lengths", "ids", "n_tokens"])

        for b in batches:
            ids, texts = b.column("id").to_pylist(), b.column("t")
            for a in range(0, len(ids), 2000):
                for d, raw in zip(ids[a:a + 2000], enc(texts.slice(a, 2000).to_pylist())):
                    raw += end
                    k = len(raw) // width
                    if docs and held + k > block:
                        yield row()
                        number, docs, lens, buf, held = number + 1, [], [], [], 0
                    docs.append(d)
                    lens.append(k)
                    buf.append(raw)
                    held += k
        if docs:
            yield row()

    return dealt.mapInArrow(run, CHUNKS)


def id_width(tokenizer: str) -> str:
    return TextEncoder(tokenizer).dtype.str


def token_counts(chunks: DataFrame, dtype: str) -> np.ndarray:
    """Occurrences of each id over all chunks (one partial sum per task, one row per id)."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            for raw in b.column("ids").to_pylist():
                c = np.bincount(np.frombuffer(raw, dtype))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
                total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    rows = chunks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max([r.id for r in rows], default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def write_token_file(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                     text: str = "text", block: int = BLOCK) -> str:
    """Write the token file of all documents under ``path`` (a folder every executor reaches)."""
    spark = df.sparkSession
    dtype = id_width(tokenizer)
    chunks = cut_lineage(tokenize_sorted(df, tokenizer, end_id, id_col, text, block))
    freq = scaled_table(token_counts(chunks, dtype))
    sizes = {r.part: r.n for r in chunks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # one row a partition
    offset, at = {}, 0
    for p in sorted(sizes):
        offset[p] = at
        at += sizes[p]
    spark.createDataFrame([(SCALE, np.flatnonzero(freq).tolist(), freq[freq > 0].tolist(), len(freq))],
                          "scale int, ids array<int>, freq array<int>, vocabulary int").write.parquet(f"{path}/table")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                payload = encode_block(np.frombuffer(b.column("ids")[i].as_py(), dtype), freq)
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in ("part", "block", "doc_ids", "lengths")),
                                                  pa.array([payload], pa.binary())],
                                                 names=["part", "block", "doc_ids", "lengths", "payload"])

    encoded = chunks.mapInArrow(run, "part int, block int, doc_ids array<long>, lengths array<int>, payload binary")
    # payloads have no redundancy left to compress
    encoded.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame(sorted(offset.items()), "part int, start long").write.parquet(f"{path}/starts")
    return path


def read_token_file(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the blocks; ``ids`` are
    little-endian uint32."""
    t = spark.read.parquet(f"{path}/table").first()
    freq = np.zeros(t.vocabulary, dtype=np.int64)
    freq[np.array(t.ids, dtype=np.int64)] = t.freq
    blocks = spark.read.parquet(f"{path}/blocks")
    lens = blocks.select("part", "block", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n"))
    # starts: parts from their file, blocks within a part by a running sum (few rows a part)
    w = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (lens.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
              .join(spark.read.parquet(f"{path}/starts"), "part").select(
                  F.col("part").alias("p"), F.col("block").alias("bl"), (F.col("start") + F.col("before")).alias("block_start")))
    placed = blocks.join(starts, (F.col("part") == F.col("p")) & (F.col("block") == F.col("bl"))).select(
        "doc_ids", "lengths", "payload", "block_start")

    def run(batches):
        tables = decode_tables(freq)
        for b in batches:
            for i in range(b.num_rows):
                raw = decode_block(b.column("payload")[i].as_py(), tables).astype("<u4").tobytes()
                n = np.array(b.column("lengths")[i].as_py(), dtype=np.int64)
                ends = np.cumsum(n)
                begin = ends - n
                parts = [raw[4 * a:4 * e] for a, e in zip(begin.tolist(), ends.tolist())]
                cols = [pa.array(b.column("doc_ids")[i].as_py(), pa.int64()), pa.array(begin + b.column("block_start")[i].as_py()),
                        pa.array(n), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    cols.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return placed.mapInArrow(run, schema)


def fresh_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-file-{uuid.uuid4().hex}"
