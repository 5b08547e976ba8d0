"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage as _cut_lineage
from ..session import ensure_checkpoint_dir  # noqa: F401  (re-exported)

# A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
# ``bytes.split()`` of UTF-8 text splits at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# The same classes spelt for a Spark SQL string literal.
SQL_GAP = r"[\\x20\\x09-\\x0D]+"
SQL_WORD_CHAR = r"[^\\x20\\x09-\\x0D]"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back. Shuffle files of the write are removed when
    it ends (the written table replaces them), so disk holds one step at a time."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return _cut_lineage(df)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def release(written: DataFrame) -> None:
    """Delete the table behind a frame made by ``cut_lineage`` once everything made from it is written."""
    spark = written.sparkSession
    files = written.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_sql(text: str) -> str:
    """SQL for the array of words of ``text`` (null: no words)."""
    return f"filter(split(coalesce({text}, ''), '{SQL_GAP}'), w -> w <> '')"


def let_sql(value: str, var: str, body: str) -> str:
    """SQL in which ``body`` sees ``value``, evaluated once, as ``var``."""
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (input tables may carry any names)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that later tasks of the worker find it.
    Functions travel to workers by value, hence the detour over ``sys.modules``."""
    import sys
    import types

    holder = sys.modules.setdefault("_oratio_worker_cache", types.ModuleType("_oratio_worker_cache"))
    return holder.__dict__.setdefault(name, {})


def forget() -> None:
    """Empty all dicts of ``worker_cache``: called by tasks of operators that keep nothing, since a worker that is
    used again by another operator would hold the last one's words (some 100 MB) beside its own."""
    import sys

    holder = sys.modules.get("_oratio_worker_cache")
    for held in vars(holder).values() if holder else ():
        if isinstance(held, dict):
            held.clear()


def partitions_for(df: DataFrame, rows: int, per_partition: int) -> int:
    """Partitions so that each holds about ``per_partition`` of ``rows``, the session's number at least."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // per_partition))


__all__ = ["WORD", "GAP", "SQL_GAP", "SQL_WORD_CHAR", "F", "table", "words_sql", "let_sql", "free_name",
           "worker_cache", "forget", "partitions_for", "cut_lineage", "release", "ensure_checkpoint_dir"]
