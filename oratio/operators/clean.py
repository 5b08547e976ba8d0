"""Cleaning, filters and predicates (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import POLITICIAN_KEYWORDS

KEY = ["surname", "code", "speech"]
MIN_CHARS = 200


def drop_incomplete(df: DataFrame, cols=KEY) -> DataFrame:
    """drop rows with a null in any of the speech columns."""
    return df.dropna("any", subset=list(cols))


def drop_exact_duplicates(df: DataFrame, id_col: str = "speech_id") -> DataFrame:
    """full-row duplicate removal, keeping the first (lowest id) row of each group.

    Partial aggregation collapses copies map-side, so a group of copies holding a large share
    of all rows reaches the reducer as one row per map task."""
    if id_col not in df.columns:
        return df.dropDuplicates(KEY)
    other = [c for c in df.columns if c not in KEY + [id_col]]
    aggs = [F.min(id_col).alias(id_col)] + [F.min_by(c, F.col(id_col)).alias(c) for c in other]
    return df.groupBy(*KEY).agg(*aggs).select(*df.columns)


def remove_links(df: DataFrame, col: str = "speech") -> DataFrame:
    """remove links from the speech text."""
    return df.withColumn(col, T.remove_links(col))


def usable_only(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """length after link removal >= min_chars, code in {0, 1}, surname present."""
    return df.where((F.length("speech") >= min_chars) & F.col("code").isin(0, 1) & F.col("surname").isNotNull())


def clean_speeches(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """F1 -> F2 -> F3 -> F4 in the reference's order.

    Filters that cannot change the outcome run before the dedup shuffle: rows shorter than
    ``min_chars`` stay too short after link removal, and code/surname are per-row tests shared
    by every copy in a duplicate group."""
    pre = drop_incomplete(df).where(
        (F.length("speech") >= min_chars) & F.col("code").isin(0, 1) & F.col("surname").isNotNull())
    return usable_only(remove_links(drop_exact_duplicates(pre)), min_chars)


def is_politician(c) -> F.Column:
    """first sentence (lower-cased) mentions who/politician/statesman; null -> false."""
    return T.contains_any(F.lower(T.col_(c)), POLITICIAN_KEYWORDS)


def speakers(df: DataFrame) -> DataFrame:
    """distinct surnames."""
    return df.select("surname").distinct()
