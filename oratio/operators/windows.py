"""Generators: sliding word windows, sentences, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import CHUNK_OVERLAP, CHUNK_SIZE


def check_window(size: int, overlap: int) -> int:
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(f"window needs 0 <= overlap < size, got size={size}, overlap={overlap}")
    return size - overlap


def windows_col(text, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """G1 as an array column: words joined by one space, window starts 0, step, 2*step, ...
    while start < n (step = size - overlap); no words -> empty array."""
    step = check_window(size, overlap)
    return T.let(T.words(text), lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)),
        lambda i: F.array_join(F.slice(w, i + 1, F.lit(size)), " "))
    ).otherwise(F.array().cast("array<string>")))


def sliding_windows(df: DataFrame, id_col: str, text: str, size: int = CHUNK_SIZE,
                    overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """G1 as rows (id, chunk_no, chunk). Narrow: no shuffle; the source text is not carried."""
    return df.select(id_col, F.posexplode(windows_col(text, size, overlap)).alias("chunk_no", "chunk"))


def sentence_rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """G2 as rows (id, sent_no, sentence), trailing empty part included as in the split."""
    return df.select(id_col, F.posexplode(T.sentences(text)).alias("sent_no", "sentence"))


def token_rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """G3 as rows (id, pos, token) of lower-cased terms."""
    return df.select(id_col, F.posexplode(T.terms(text)).alias("pos", "token"))
