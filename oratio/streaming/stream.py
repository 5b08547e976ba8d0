"""Structured Streaming form of the row-local enrichment.

Every analysis column of the enrichment is a function of one row, so the same expressions run
unchanged on an unbounded source: read -> F1/F3/F4 -> lexicons, propaganda search, keywords,
narrative, readability, persuasion -> sink. Duplicate removal needs state; with an event-time
column it is bounded by a watermark (``dropDuplicatesWithinWatermark``; the first copy to
arrive is kept, where the batch form keeps the lowest id), without one it is off.
Profile and response lookups are stream-static joins against tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..operators.profiles import PROFILE_FIELDS, add_profiles
from ..operators.responses import add_responses, latest_responses
from ..plans.enrich import OUTPUT_COLUMNS, analyse

SPEECH_SCHEMA = "speech_id bigint, surname string, code int, speech string"


def enrich_stream(stream: DataFrame, profiles: DataFrame | None = None, responses: DataFrame | None = None,
                  event_time: str | None = None, watermark: str = "1 hour", tone_lexicon=None) -> DataFrame:
    """Enrichment over a streaming DataFrame of speeches (same columns as the batch form)."""
    df = clean.drop_incomplete(stream)
    if event_time:
        df = df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(clean.KEY))
    df = clean.usable_only(clean.remove_links(df))
    if profiles is not None:
        df = add_profiles(df, profiles.select("surname", *PROFILE_FIELDS))
    else:
        for f in PROFILE_FIELDS:
            df = df.withColumn(f, F.lit(None).cast("string"))
    if responses is not None:
        df = add_responses(df, latest_responses(responses))
    else:
        from ..operators.responses import FIELDS
        for f in FIELDS:
            df = df.withColumn(f, F.lit("N/A"))
    df = analyse(df, tone_lexicon)
    df = df.withColumn("sentiment", F.lit(None).cast("string")).withColumn("emotion", F.lit(None).cast("string"))
    return df.select("speech_id", *OUTPUT_COLUMNS)


def read_speech_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = SPEECH_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File source of speech rows (new files are picked up as they land)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
          query_name: str | None = None, trigger: dict | None = None):
    """Start the streaming write (append mode; the checkpoint makes restarts exactly-once for
    file sinks)."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format(sink)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()
