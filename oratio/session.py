"""Session helpers: local session for tests and bench, shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Session setting: partitions that single-row-group inputs are dealt over. Unset (the default on a
# cluster): inputs keep the partitions of their scan. Test and bench sessions set it, their files
# have one row group each.
SCAN_PARTITIONS = "spark.oratio.scan.partitions"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "oratio",
                  checkpoint_dir: str | None = None, scan_partitions: int = 8) -> SparkSession:
    """A local session configured the way the library expects a cluster to be configured. Tests
    and the bench name a checkpoint folder; a cluster sets ``spark.checkpoint.dir`` itself."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # CPU-heavy rows: tiny local inputs keep one partition per shuffle slot
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast decisions from measured sizes at run time, not from plan estimates
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "10g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config(SCAN_PARTITIONS, str(scan_partitions))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; an error when it is unset
    (a folder of this machine would not be seen by other executors)."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


# Session setting: shuffle files of an execution go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint folder and reading it
    back: computed once (``Dataset.checkpoint`` computes its input twice), stored reliably, so a
    lost executor never forces recomputation of what came before. The written table replaces the
    write's shuffle files, which are removed as it ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/oratio-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal an input over ``spark.oratio.scan.partitions`` partitions by ``key`` when that setting
    is given (test files have one row group); otherwise return it unchanged, without a shuffle."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n), key) if n else df
