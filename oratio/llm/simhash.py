"""SimHash near-duplicates with pigeonring candidate filtering.

A 64-bit fingerprint is cut into four 16-bit segments laid on a ring. If two fingerprints differ
in at most 3 bits, some segment i starts a chain whose cumulative differences stay within the
proportional budgets floor(3 l / 4): none in segment i, at most 1 over i..i+1, at most 2 over
i..i+2, at most 3 over the whole ring. The first two budgets are the index: a key holds the start
i, segment i exactly, and segment i+1 with one bit masked (16 positions), so any pair within the
first two budgets shares a key. The further budgets prune before the full Hamming check.

Scale: equal fingerprints collapse first (partial aggregation). Keys with two members give their
pair from min and max of one aggregation, no join. Keys with more members are dealt into cells of
at most two blocks of ``BLOCK`` fingerprints each, so every pair of blocks meets once and no task
holds more than a cell, however many near copies share a key; a cell returns a spanning forest of
its links, never all pairs. The cells of one cluster are nearly always equal for all its keys and
are collapsed before they are compared.

Defined cases: a null or wordless text has fingerprint 0 and links like any other; repeated rows
are equal fingerprints; an empty table gives an empty result; a null id takes part and is ignored
when the smallest id is chosen (a component of null ids only has a null component_id).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, forget, free_name, partitions_for
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 2048
PART = 8192  # fingerprints whose ring keys one task makes and counts


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text (A-Z lower-cased, word shingles, XXH64 seed 42)."""
    import xxhash

    w = (text or "").encode().lower().split()  # bytes.lower() changes A-Z only
    if not w:
        return 0
    grams = [b" ".join(g) for g in zip(*(w[i:] for i in range(shingle)))] if len(w) >= shingle else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):  # 64 bytes a shingle at a time
        ones += np.unpackbits(h[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def add_fingerprint(df: DataFrame, text: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint as a signed long column."""
    @F.pandas_udf("long")
    def simhash(s: pd.Series) -> pd.Series:
        forget()
        return pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return df.withColumn(out, simhash(F.col(text)))


def _segment(fp: str, i: int) -> str:
    return f"(shiftrightunsigned({fp}, {16 * (i % 4)}) & 65535L)"


def ring_keys(fps: DataFrame) -> DataFrame:
    """(k, fp): the 64 ring keys of each fingerprint: start, exact segment, masked next segment."""
    keys = []
    for i in range(4):
        a, b = _segment("fp", i), _segment("fp", i + 1)
        keys.append(f"transform(sequence(0, 15), p -> shiftleft({i}L * 16 + p, 32) | shiftleft({a}, 16) "
                    f"| ({b} & ~shiftleft(1L, p)))")
    return fps.select(F.explode(F.expr(f"concat({', '.join(keys)})")).alias("k"), "fp")


def within_budgets(a, b):
    """Pigeonring test of two uint64 arrays (broadcast together): a chain of segments from some
    start stays within the budgets; ends with the full Hamming check."""
    x = a ^ b
    seg = [np.bitwise_count((x >> np.uint64(16 * i)) & np.uint64(0xFFFF)) for i in range(4)]
    chain = np.zeros(x.shape, dtype=bool)
    for i in range(4):
        two = seg[i] + seg[(i + 1) % 4]
        chain |= (seg[i] == 0) & (two <= 1) & (two + seg[(i + 2) % 4] <= 2)
    return chain & (np.bitwise_count(x) <= MAX_BITS)


def spanning_links(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest among the given fingerprints: breadth first, one row of the
    comparison at a time, so memory stays linear in the cell."""
    left = np.unique(fp)
    links = []
    while len(left):
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            new = []
            for f in wave:
                hit = within_budgets(left, f)
                if hit.any():
                    new.append(left[hit])
                    links += [(int(f), int(g)) for g in left[hit]]
                    left = left[~hit]
                if not len(left):
                    break
            wave = np.concatenate(new) if new else left[:0]
    return links


def fingerprint_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v) links that connect all fingerprints of ``fps`` (distinct, column ``fp``) whose Hamming
    distance is at most 3, up to transitivity."""
    # 64 keys a fingerprint: a small table is read by a task or two, whose partial counts would hold all keys of the corpus
    keys = ring_keys(fps.repartition(partitions_for(fps, fps.count(), PART), "fp"))
    count = cut_lineage(keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"),
                                              F.max("fp").alias("b")).where("n > 1"))
    hamming = F.expr("bit_count(a ^ b)")
    pairs = count.where("n = 2").where(hamming <= MAX_BITS).select(F.col("a").alias("u"), F.col("b").alias("v"))

    # keys with three members or more: blocks by hash, one cell for each pair of blocks
    hot = count.where("n > 2").select("k", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    member = keys.join(hot, "k").withColumn("x", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cells = member.select("k", "fp", F.explode(F.expr(
        "transform(sequence(0, blocks - 1), y -> struct(least(x, y) AS p, greatest(x, y) AS q))")).alias("cell"))
    lists = (cells.groupBy("k", "cell").agg(F.sort_array(F.collect_list("fp")).alias("members"))
             .select("members").distinct())

    def link(batches):
        for pdf in batches:
            rows = [p for m in pdf["members"] for p in spanning_links(np.asarray(m, dtype=np.int64).view(np.uint64))]
            if rows:
                uv = np.array(rows, dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"u": uv[:, 0], "v": uv[:, 1]})

    return pairs.unionAll(lists.mapInPandas(link, "u long, v long")).distinct()


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  block: int = BLOCK) -> DataFrame:
    """``df`` with ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id of all documents
    reachable by links), under the next free names if the table has such columns."""
    fp, comp = free_name(df, "fingerprint"), free_name(df, "component_id")
    small = cut_lineage(add_fingerprint(df.select(F.col(id_col).alias("id"), F.col(text).alias("t")), "t", "fp", shingle)
                        .select("id", "fp"))
    roots = component_roots(small, block)
    marked = (small.join(roots, "fp", "left").select(
        "id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias(fp), F.col("root").alias(comp)))
    return marked.withColumnRenamed("id", id_col)


def component_roots(small: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fp, root): the smallest id among all rows whose fingerprint is reachable from ``fp``."""
    fps = cut_lineage(small.groupBy("fp").agg(F.min("id").alias("least")))
    comps = connected_components(fingerprint_links(fps.select("fp"), block))
    named = fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("c"))
    roots = named.groupBy("c").agg(F.min("least").alias("root"))
    return named.join(roots, "c").select("fp", "root")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the row with the smallest id. Repeated rows of one id count as
    one document: of those whose texts differ, a row stays whose fingerprint has that id as its component (the least such
    fingerprint, then the least row in the order of text and the other columns). Rows without an id cannot be named as
    anyone's duplicate and stay."""
    marked = simhash_dedup(df, id_col, text)
    fp, comp = marked.columns[-2:]
    ids = (marked.groupBy(F.col(id_col).alias("__id")).agg(
        F.min(F.when(F.col(id_col) == F.col(comp), F.col(fp))).alias("__fp"), (F.min(fp) < F.max(fp)).alias("__mixed"))
        .where("__fp IS NOT NULL"))
    rows = df.where(F.col(id_col).isNotNull()).join(ids, F.col(id_col) == F.col("__id"))
    rows = add_fingerprint(rows.withColumn("__text", F.when(F.col("__mixed"), F.col(text))), "__text", "__own")  # null: no work
    rows = rows.where(~F.col("__mixed") | (F.lpad(F.lower(F.hex("__own")), 16, "0") == F.col("__fp")))
    order = [F.col(text), *[F.col(c) for c, kind in df.dtypes if c not in (id_col, text) and "map<" not in kind]]
    kept = rows.withColumn("__r", F.row_number().over(Window.partitionBy("__id").orderBy(*order))).where("__r = 1")
    return kept.select(*df.columns).unionByName(df.where(F.col(id_col).isNull()))
