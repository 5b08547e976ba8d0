"""Embeddings: chunk embedding, mean pooling, 2-D projection."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import CHUNK_OVERLAP, CHUNK_SIZE
from .windows import sliding_windows


def pool_embeddings(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Element-wise mean of the vectors of each key. One aggregation with a map-side
    partial mean per key, so a key holding a third of the rows is summed in parallel."""
    v = df.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("__v"))
    return (v.groupBy(key).agg(Summarizer.mean(F.col("__v")).alias("__m"))
             .select(key, vector_to_array("__m").alias(vec)))


def with_zero_default(df: DataFrame, vec: str, dim: int) -> DataFrame:
    """E2 tail: a speech without chunks gets the zero vector."""
    return df.withColumn(vec, F.coalesce(F.col(vec), F.array_repeat(F.lit(0.0), dim)))


def hashed_vector_sql(words: str, dim: int) -> str:
    """SQL for the mean of signed hashed one-hot vectors of the lower-cased ``words``: a word counts +1 or -1 in one of ``dim``
    places, both from the first 32 bits of its MD5. The codes are sorted and their runs counted, so the
    cost per word does not grow with ``dim``. No words: zeros."""
    code = f"CAST(conv(substring(md5(lower(w)), 1, 8), 16, 10) AS BIGINT) % {2 * dim}"
    starts = "filter(sequence(1, size(c)), i -> i = 1 OR get(c, i - 1) <> get(c, i - 2))"
    runs = "transform(st, (p, k) -> coalesce(get(st, k + 1), size(c) + 1) - p)"
    value = "(coalesce(try_element_at(m, 2 * d), 0) - coalesce(try_element_at(m, 2 * d + 1), 0)) / CAST(size(c) AS DOUBLE)"
    dense = f"transform(sequence(0L, {dim - 1}L), d -> {value})"
    counted = T.sql_let(starts, "st", T.sql_let(f"map_from_arrays(transform(st, p -> get(c, p - 1)), {runs})", "m", dense))
    return T.sql_let(f"sort_array(transform({words}, w -> {code}))", "c",
                     f"CASE WHEN size(c) > 0 THEN {counted} ELSE array_repeat(0D, {dim}) END")


def fit_word2vec(df: DataFrame, text: str, dim: int = 64, min_count: int = 5, seed: int = 42, **options):
    """E1 with trained word vectors: Spark ML's Word2Vec on the whole table. Its vocabulary (words seen ``min_count`` times)
    times ``dim`` lies in the driver: raise ``min_count`` with the size of the corpus."""
    words = df.select(F.transform(T.words(text), F.lower).alias("__w"))
    return Word2Vec(vectorSize=dim, minCount=min_count, seed=seed, inputCol="__w", outputCol="__v", **options).fit(words)


def chunk_embeddings(df: DataFrame, id_col: str, text: str, embedder=None, dim: int = 64,
                     size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(id, chunk_no, embedding) for each sliding window. ``embedder``: None for hashed words (SQL, no Python), a
    model of ``fit_word2vec`` (mean of its word vectors, in the JVM), or a callable ``texts -> (n, dim) array``,
    which gets Arrow batches."""
    chunks = sliding_windows(df, id_col, text, size, overlap)
    if embedder is None:
        return chunks.select(id_col, "chunk_no", F.expr(hashed_vector_sql(T.sql_words("chunk"), dim)).alias("embedding"))
    if isinstance(embedder, Word2VecModel):
        worded = chunks.select(id_col, "chunk_no", F.transform(T.words("chunk"), F.lower).alias(embedder.getInputCol()))
        return embedder.transform(worded).select(id_col, "chunk_no", vector_to_array(embedder.getOutputCol()).alias("embedding"))

    def run(it):
        for pdf in it:
            vecs = embedder(list(pdf["chunk"])) if len(pdf) else np.zeros((0, dim))
            yield pd.DataFrame({id_col: pdf[id_col].values, "chunk_no": pdf["chunk_no"].values,
                                "embedding": [list(map(float, v)) for v in vecs]})

    return chunks.mapInPandas(run, f"{id_col} {dict(df.dtypes)[id_col]}, chunk_no int, embedding array<double>")


def speech_embeddings(df: DataFrame, id_col: str, text: str, embedder=None, dim: int = 64) -> DataFrame:
    """E1+E2: speech vector = mean of its chunk vectors; speeches without words (F8: null ones too) -> zeros."""
    pooled = pool_embeddings(chunk_embeddings(df, id_col, text, embedder, dim), id_col, "embedding")
    return with_zero_default(df.select(id_col).join(pooled, id_col, "left"), "embedding", dim)


def project_2d(df: DataFrame, id_col: str, vec: str, seed: int = 42) -> DataFrame:
    """PCA to two coordinates (the covariance is a dim x dim aggregate, independent of the
    row count); each axis' sign is fixed so its largest-magnitude loading is positive."""
    v = df.select(id_col, array_to_vector(F.col(vec).cast("array<double>")).alias("__v"))
    model = PCA(k=2, inputCol="__v", outputCol="__p").fit(v)
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(2)]
    out = model.transform(v).select(id_col, vector_to_array("__p").alias("__a"))
    return out.select(id_col, (F.col("__a")[0] * signs[0]).alias("x"), (F.col("__a")[1] * signs[1]).alias("y"))
