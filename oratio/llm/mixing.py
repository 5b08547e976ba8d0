"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same wanted number of copies r = target / source size: floor(r)
whole copies and one more with probability r - floor(r). Pivotal rounding settles the fractions: two
documents meet, a random transfer of mass between them (in words, so the source's total is kept
exactly) makes one of them integral, the other goes on. Within a source, buckets of documents are
reduced in parallel; each leaves one fractional document, and those residuals meet again in a
reduction tree until one per source is left, which is rounded at random with its own probability.
A source therefore misses its target by less than one document.

Targets: sources in code-point order (null last) carry the weights in turn; each target is capped
at ``cap`` times the source's size and the excess is reshared by weight among the others until none
is above (solved on the source table, one aggregated row a round).

Scale: only (row id, size) is shuffled, dealt by (source, bucket) with about ``BUCKET`` rows each, so a source
with a third of all rows is many buckets. Random numbers are hashes of ids and the seed, and rows
meet in a fixed order, so reruns agree whatever the partitioning.

Defined cases: a null or wordless text has size 0 and takes no part in the words (its copies are
the whole part of r); a null source is a source of its own, last in order; repeated rows are
documents of their own; an empty table gives an empty result; source totals of 0 give target 0.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SQL_GAP, cut_lineage, free_name

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKET = 2048
FANIN = 64
SEED = 7


def size_sql(text: str) -> str:
    return f"CAST(size(array_remove(split(coalesce({text}, ''), '{SQL_GAP}'), '')) AS BIGINT)"


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs, target) of ``sizes`` (source, size)."""
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    w = F.array(*[F.lit(int(x)) for x in weights])
    ranked = cut_lineage(_ranked(stats).withColumn("w", F.element_at(w, (F.col("pos") % len(weights)).cast("int") + 1)))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words for each unit of weight; sources whose cap lies below it stand at their cap
    while total:
        at_cap = F.col("w") * level >= F.col("source_size") * cap
        r = ranked.agg(F.sum(F.when(at_cap, F.col("source_size") * cap)).alias("capped"),
                       F.sum(F.when(~at_cap, F.col("w"))).alias("w")).first()
        if not r.w:
            break
        now = (total - (r.capped or 0)) / r.w
        if now <= level:
            break
        level = now
    return ranked.select("source", "source_size", "n_docs",
                         F.least(F.col("w") * F.lit(level), (F.col("source_size") * cap).cast("double")).alias("target"))


def _ranked(stats: DataFrame) -> DataFrame:
    """Position of each source in code-point order, null last: ranges are counted first, then each
    range numbers its own rows, so no task sorts all sources."""
    spread = stats.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    held = cut_lineage(spread.withColumn("part", F.spark_partition_id()))
    before = held.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a range
    offset, starts = 0, {}
    for r in sorted(before, key=lambda r: r.part):
        starts[r.part] = offset
        offset += r.n
    start = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]) if starts else None
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    pos = F.element_at(start, F.col("part")) + own if starts else own
    return held.withColumn("pos", pos).drop("part")


def _uniform(*key) -> float:
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little") / 2.0 ** 64


def pivot(items, seed, level):
    """Pivotal rounding of (id, copy, size, p) in the given order: yields (id, copy, extra) for every settled
    document, then returns the one left with a fraction (or None). The transfer keeps the words."""
    held, settled = None, []
    for rid, copy, size, p in items:
        if size == 0 or p <= 0.0 or p >= 1.0:
            settled.append((rid, copy, int(p >= 1.0)))
            continue
        if held is None:
            held = (rid, copy, size, p)
            continue
        hid, hcopy, hs, hp = held
        # up: words that can move to the held document; down: away from it
        up = min((1.0 - hp) * hs, p * size)
        down = min(hp * hs, (1.0 - p) * size)
        if _uniform(seed, level, hid, hcopy, rid, copy) * (up + down) < down:
            moved, full_h, full_o = up, up == (1.0 - hp) * hs, up == p * size
            hp, p = (1.0 if full_h else hp + moved / hs), (0.0 if full_o else p - moved / size)
        else:
            moved, full_h, full_o = down, down == hp * hs, down == (1.0 - p) * size
            hp, p = (0.0 if full_h else hp - moved / hs), (1.0 if full_o else p + moved / size)
        held = None
        for x in ((hid, hcopy, hs, hp), (rid, copy, size, p)):
            if 0.0 < x[3] < 1.0:
                held = x
            else:
                settled.append((x[0], x[1], int(x[3] >= 1.0)))
    return settled, held


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        cap: int = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: ``id_col``, ``copy`` (0, 1, ... among rows of one id), ``size``, ``source_size``, ``target``, ``copies``."""
    quoted = "`" + text.replace("`", "``") + "`"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.expr(size_sql(quoted)).alias("size"),
                     F.col(source).alias("source"))
    rows = cut_lineage(rows)
    targets = cut_lineage(source_targets(rows.select("source", "size"), weights, cap).withColumn(
        "src", F.xxhash64("source", F.col("source").isNull())))
    # rows of one id are numbered by size and source, so that each is a document of its own
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("rid")).limit(1)
    if repeated.head(1):
        w = Window.partitionBy("id").orderBy("size", F.col("source").asc_nulls_last())
        rows = rows.withColumn("copy", (F.row_number().over(w) - 1).cast("long"))
    else:
        rows = rows.withColumn("copy", F.lit(0).cast("long"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumn("base", F.floor(ratio).cast("long")).withColumn("p", ratio - F.col("base"))
    t = t.withColumn("buckets", F.ceil(F.col("n_docs") / F.lit(BUCKET)).cast("long"))
    joined = rows.join(t, rows["source"].eqNullSafe(t["source"])).select(
        "id", "copy", "size", "src", "source_size", "target", "base", "p",
        F.pmod(F.xxhash64("id", "copy"), F.col("buckets")).alias("bucket"))
    settled = cut_lineage(_round(joined.select("id", "copy", "size", "src", "bucket", "p"), seed, 0))
    done = [settled.where("NOT open")]
    for level in range(1, 12):
        rest = settled.where("open")
        if not rest.head(1):
            break
        up = rest.select("id", "copy", "size", "src", F.floor(F.col("bucket") / FANIN).alias("bucket"), "p")
        settled = cut_lineage(_round(up, seed, level))
        done.append(settled.where("NOT open"))
        if not settled.where("open AND bucket > 0").head(1):  # one bucket a source: its last fraction is drawn
            done.append(settled.where("open").withColumn("extra", (F.col("u") < F.col("p")).cast("long")))
            break
    extra = done[0].select("id", "copy", "extra")
    for d in done[1:]:
        extra = extra.unionAll(d.select("id", "copy", "extra"))
    return joined.join(extra.withColumnRenamed("id", "i2").withColumnRenamed("copy", "c2"),
                       F.col("id").eqNullSafe(F.col("i2")) & (F.col("copy") == F.col("c2"))).select(
        F.col("id").alias(id_col), "copy", "size", "source_size", "target", (F.col("base") + F.col("extra")).alias("copies"))


def _round(rows: DataFrame, seed: int, level: int) -> DataFrame:
    """Pivotal rounding within each (src, bucket); the fractional document of a bucket stays open."""
    schema = "id long, copy long, size long, src long, bucket long, p double, extra long, open boolean, u double"

    def settle(key, pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: the one left over tends to be small
        items = [(None if pd.isna(i) else int(i), int(c), int(s), float(p))
                 for i, c, s, p in zip(pdf["id"].astype("object"), pdf["copy"], pdf["size"], pdf["p"])]
        items.sort(key=lambda x: (-x[2], x[0] is None, x[0] or 0, x[1]))
        done, held = pivot(items, seed, level)
        size = {(i, c): s for i, c, s, _ in items}
        out = [(i, c, size[i, c], key[0], key[1], 0.0, e, False, 0.0) for i, c, e in done]
        if held is not None:
            i, c, s, p = held
            out.append((i, c, s, key[0], key[1], p, 0, True, _uniform(seed, "last", i, c)))
        pdf = pd.DataFrame(out, columns=["id", "copy", "size", "src", "bucket", "p", "extra", "open", "u"])
        pdf["id"] = pdf["id"].astype("Int64")
        return pdf

    return rows.groupBy("src", "bucket").applyInPandas(settle, schema)


def expand(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
           cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each row of ``df`` as often as it was given copies. Rows of one id are told
    apart by size and source as in ``mix``; equal ones share the sum of their copies in turn."""
    m = mix(df, id_col, text, source, weights, cap, seed).select(F.col(id_col).alias("__id"), F.col("copy").alias("__copy"),
                                                                 F.col("copies").alias("__n")).where("__n > 0")
    single = m.groupBy("__id").agg(F.max("__copy").alias("__most"), F.sort_array(F.collect_list(F.struct("__copy", "__n"))).alias("__c"))
    quoted = "`" + text.replace("`", "``") + "`"
    n = free_name(df, "__times")
    joined = df.join(single, F.col(id_col).eqNullSafe(F.col("__id")))
    one = joined.where("__most = 0").withColumn(n, F.col("__c")[0]["__n"])
    w = Window.partitionBy("__id").orderBy(F.expr(size_sql(quoted)), F.col(source).asc_nulls_last())
    many = (joined.where("__most > 0").withColumn("__r", (F.row_number().over(w) - 1).cast("long"))
            .withColumn(n, F.coalesce(F.expr("filter(__c, x -> x.__copy = __r)")[0]["__n"], F.lit(0).cast("long"))).drop("__r"))
    both = one.unionByName(many).where(F.col(n) > 0)
    return both.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*df.columns)
