"""URL allow and block rules as a sort-merge range join.

A rule (host, path prefix) holds for its host and all subdomains. Written with its labels reversed
and closed by a separator (``net``, ``example`` -> ``net\\x00example\\x00``; the separator itself is escaped inside labels), a
host is a prefix of all its subdomains, so the rule's host is an interval of the sorted key space. Urls are
range-partitioned by that key; every range gets the rules whose interval meets it: those between its bounds and those
that are open at its first key. Rules and urls of a range are read in key order, rules first, by one sweep that keeps a
stack of the nested rules open at the current key. The open rules whose path prefix fits compete; the longest host
and path wins.

The second range column is a hash of url and row, so a host or url with a third of all rows is dealt over several
ranges. A task holds the rules open at one key, however long the rule table; the driver holds two keys a range.

Defined cases: a null url or one without ``://`` has empty host and path, meets no rule and gets
the default verdict; two rules of equal host and path: block wins; rules with a null host or path are not used; an empty
rule table gives the default everywhere; other columns pass through (of types that Parquet holds).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_name

DEFAULT_VERDICT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEP = "\x00"  # sorts below every character of a host, so an interval has no strangers in it


def url_parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path): between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased;
    then up to ``?`` or ``#``. Both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: F.Column) -> F.Column:
    """Labels reversed, each closed by the separator; U+0000 and U+0001 inside a label become two characters, none of
    them the separator."""
    safe = F.replace(F.replace(host, F.lit("\x01"), F.lit("\x01\x02")), F.lit(SEP), F.lit("\x01\x01"))
    return F.concat(F.array_join(F.reverse(F.split(safe, r"\.", -1)), SEP), F.lit(SEP))


class Sweep:
    """Rules and urls in key order: ``rule`` opens one, ``judge`` gives the winner at a key for a path. The stack holds
    (key, host, path, action) of the open rules, outermost first."""

    def __init__(self):
        self.stack, self.key, self.best = [], None, []

    def _close(self, key):
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def rule(self, key, host, path, action):
        self._close(key)
        self.stack.append((key, host, path, action))
        self.key = None

    def judge(self, key, path):
        if key != self.key:
            self._close(key)
            self.key = key
            # longest first; on equal length of host and path the longer host, then block before allow
            self.best = sorted(self.stack, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]), r[3] != "block"))
        return next((r for r in self.best if path.startswith(r[2])), None)


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, action) rows from a list."""
    return spark.createDataFrame(rules, "host string, path string, action string")


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (host and path of the winner, or null) and ``verdict``, under
    the next free names."""
    names = {}
    for n in ("host", "path", "rule", "verdict", "__key", "__range", "__rule"):
        names[n] = free_name(df, n)
    host, path = url_parts(F.col(url))
    keyed = df.withColumn(names["host"], host).withColumn(names["path"], path)
    keyed = keyed.withColumn(names["__key"], host_key(F.col(names["host"])))
    salt = F.xxhash64(F.col(url), F.monotonically_increasing_id())
    ranged = cut_lineage(keyed.repartitionByRange(F.col(names["__key"]), salt).withColumn(names["__range"], F.spark_partition_id()))
    at = F.col(names["__range"])
    bounds = ranged.groupBy(at.alias("range")).agg(F.min(names["__key"]).alias("lo"), F.max(names["__key"]).alias("hi")).orderBy("range").collect()

    # a rule goes to the ranges that its interval of keys meets
    clean = rules.where("host IS NOT NULL AND path IS NOT NULL").select("host", "path", "action").distinct()
    dealt = _rules_by_range(clean.select(host_key(F.col("host")).alias("key"), "host", "path", "action"),
                            [(b.range, b.lo.encode(), b.hi.encode()) for b in bounds])
    rule = F.struct("host", "path", "action")
    as_rows = dealt.select(F.col("range").alias(names["__range"]), F.col("key").alias(names["__key"]), rule.alias(names["__rule"]))
    both = ranged.withColumn(names["__rule"], F.lit(None).cast(as_rows.schema[names["__rule"]].dataType)).unionByName(
        as_rows, allowMissingColumns=True)
    key, which = names["__key"], names["__rule"]
    sorted_ = both.repartition(names["__range"]).sortWithinPartitions(names["__range"], key, F.col(which).isNull())
    kept = [c for c in keyed.columns if c != key]
    nothing = F.lit(None).cast("string")
    schema = sorted_.select(*kept, nothing.alias(names["rule"]), nothing.alias(names["verdict"])).schema
    fields = {n: both.columns.index(names[n]) for n in ("__range", "__key", "__rule", "path")}
    places = [both.columns.index(c) for c in kept]

    def run(batches):
        now, sweep_ = None, None
        for b in batches:
            mine, won, verdict = [], [], []
            ranges, keys, ruled, paths = (b.column(fields[n]).to_pylist() for n in ("__range", "__key", "__rule", "path"))
            for i, (r, k, rule_, p) in enumerate(zip(ranges, keys, ruled, paths)):
                if r != now:
                    now, sweep_ = r, Sweep()
                if rule_ is not None:
                    sweep_.rule(k, rule_["host"], rule_["path"], rule_["action"])
                    continue
                best = sweep_.judge(k, p)
                mine.append(i)
                won.append(best and best[1] + best[2])
                verdict.append(default if best is None or best[3] is None else best[3])
            urls = b.take(pa.array(mine, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(urls.column(c) for c in places), pa.array(won, pa.string()), pa.array(verdict, pa.string())],
                                             names=schema.names)

    return sorted_.mapInArrow(run, schema)


def _rules_by_range(rules: DataFrame, bounds: list[tuple[int, bytes, bytes]]) -> DataFrame:
    """(range, key, host, path, action): each rule for the ranges that hold a key it may be a prefix of. ``bounds``: (range,
    least key, greatest key), ascending, keys as bytes, the order Spark sorts by."""
    from bisect import bisect_left

    highs, lows = [b[2] for b in bounds], [b[1] for b in bounds]

    def run(batches):
        for b in batches:
            row, range_ = [], []
            for i, k in enumerate(b.column(0).to_pylist()):
                head = k.encode()
                meets = range(bisect_left(highs, head), bisect_left(lows, head + b"\xff"))
                row += [i] * len(meets)
                range_ += [bounds[j][0] for j in meets]
            yield pa.RecordBatch.from_arrays([pa.array(range_, pa.int32()), *b.take(pa.array(row, pa.int64())).columns],
                                             names=["range", "key", "host", "path", "action"])

    return rules.mapInArrow(run, "range int, key string, host string, path string, action string")
