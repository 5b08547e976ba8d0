"""Parquet table access and the speech view derived from the driver tables.

The speech table of the enrichment is (surname, code, speech). Over the driver tables it is
``documents`` (text as speech, source as surname) with ``labels.toxic`` as the binary code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def speeches_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(speech_id, surname, code, speech) before any cleaning; unlabelled rows get a null code. Labels grow with the
    documents, so the join has one form at every size."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("speech_id"), F.col("source").alias("surname"), F.col("text").alias("speech"))
    docs = spread(docs, "speech_id")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("speech_id"),
                                                   F.col("toxic").alias("code"))
    return docs.join(labels.hint("merge"), "speech_id", "left").select("speech_id", "surname", "code", "speech")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views (for the SQL forms of the queries)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
