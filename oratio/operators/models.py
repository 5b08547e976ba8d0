"""Model scoring (M1-M6).

Two ways to attach a classifier column:

* ``Scorer``: any Python model given as a loader (called once per task, so weights are loaded
  once per executor task, not per row) returning ``texts -> (n, k) scores``; rows travel to it
  in Arrow batches through an iterator pandas UDF. Whole texts are passed; any length limit is
  the model's own tokenizer's.
* Spark ML pipelines trained where labels exist (M6): tokenizer -> hashed TF -> IDF ->
  logistic regression, all JVM-side; ``label_from_model`` turns the probability vector into a
  capitalised label without leaving the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import EMOTION_LABELS, SENTIMENT_LABELS
from ..session import cut_lineage

BLOCK_MB = 8.0  # training rows that a task stacks into one matrix
SPLIT = 16 << 20  # bytes of texts in a cutting task and of stored counts in a training task, which keeps about ten times as much in memory


def _capitalize(s: str) -> str:
    return s[:1].upper() + s[1:].lower()


class Scorer:
    """M1: arg-max label of a Python model's class scores, label capitalised."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]], labels: list[str]):
        self.load, self.labels = load, list(labels)

    def column(self, text: Column) -> Column:
        load, labels = self.load, [_capitalize(x) for x in self.labels]

        @F.pandas_udf("string")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for s in batches:
                texts = s.fillna("").astype(str)
                if len(texts) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                idx = np.asarray(model(list(texts))).argmax(axis=1)
                yield pd.Series([labels[i] for i in idx])

        return score(text)

    def add(self, df: DataFrame, text: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(F.col(text)))


def sentiment_scorer(load) -> Scorer:
    """M2: five sentiment labels, very negative … very positive."""
    return Scorer(load, SENTIMENT_LABELS)


def emotion_scorer(load) -> Scorer:
    """M3: six emotion labels."""
    return Scorer(load, EMOTION_LABELS)


def fit_text_classifier(df: DataFrame, text: str, label: str, num_features: int = 1 << 18,
                        max_iter: int = 50, reg: float = 0.01) -> PipelineModel:
    """M6: train a text classifier where labels exist (in place of downloaded weights).
    Hashed features keep the model size fixed whatever the vocabulary."""
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__tok", pattern=T.TERM, gaps=False, toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="__features"),
        LogisticRegression(featuresCol="__features", labelCol=label, maxIter=max_iter, regParam=reg,
                           probabilityCol="__prob", predictionCol="__pred", rawPredictionCol="__raw"),
    ])
    return pipe.fit(df.select(text, F.col(label).cast("double").alias(label)))


def label_from_model(model: PipelineModel, df: DataFrame, text: str, labels: list[str], out: str,
                     prob_out: str | None = None) -> DataFrame:
    """M1 for a Spark ML model: arg-max class as a capitalised label (+ its probability)."""
    names = F.array(*[F.lit(_capitalize(x)) for x in labels])
    scored = model.transform(df).withColumn("__p", vector_to_array("__prob"))
    scored = scored.withColumn(out, F.element_at(names, F.col("__pred").cast("int") + 1))
    if prob_out:
        scored = scored.withColumn(prob_out, F.array_max("__p"))
    return scored.drop("__tok", "__tf", "__features", "__prob", "__pred", "__raw", "__p")


class LabelModel:
    """A trained model of any number of labels (M1-M3): ``labels`` in ascending order, the fitted pipeline and its input limit.
    Only the first ``max_terms`` terms of a text count, as with a model of limited input."""

    def __init__(self, model: PipelineModel, labels: list[str], max_terms: int):
        self.model, self.labels, self.max_terms = model, labels, max_terms

    def score(self, df: DataFrame, text: str, out: str, prob_out: str | None = None) -> DataFrame:
        """``df`` with the label of the greatest probability, capitalised; of equal ones the first label. JVM only."""
        tf = self.model.stages[0]
        return self.score_counts(tf.transform(df.withColumn("__tok", first_terms(text, self.max_terms))), out, prob_out)

    def score_counts(self, df: DataFrame, out: str, prob_out: str | None = None) -> DataFrame:
        """``score`` of rows that ``term_counts`` has cut and hashed."""
        scored = PipelineModel(self.model.stages[1:]).transform(df)
        p = vector_to_array("__prob")
        names = F.array(*[F.lit(_capitalize(x)) for x in self.labels])
        scored = scored.withColumn("__p", p).withColumn(out, F.element_at(names, F.array_position("__p", F.array_max("__p")).cast("int")))
        if prob_out:
            scored = scored.withColumn(prob_out, F.array_max("__p"))
        return scored.drop("__tok", "__tf", "__features", "__prob", "__pred", "__raw", "__p")


def first_terms(text: str, max_terms: int, start: int = 8) -> Column:
    """The first ``max_terms`` terms of a text; none for a null text. A long text is searched to its end only if its first
    ``start * max_terms`` characters hold no more terms than wanted (the last one found there may be cut)."""
    head = F.regexp_extract_all(F.substring(F.lower(text), 1, start * max_terms), F.lit(T.TERM), 0)
    found = F.when(F.length(text) <= start * max_terms, T.terms(text)).otherwise(
        T.let(head, lambda t: F.when(F.size(t) > max_terms, t).otherwise(T.terms(text))))
    return F.coalesce(F.slice(found, 1, max_terms), F.array().cast("array<string>"))


def term_counts(df: DataFrame, text: str, max_terms: int = 512, num_features: int = 1 << 16) -> DataFrame:
    """``df`` with the hashed counts of a text's first terms (``__tf``) in place of the text."""
    tf = HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features)
    return tf.transform(df.withColumn("__tok", first_terms(text, max_terms)).drop(text)).drop("__tok")


@contextmanager
def _split(spark: SparkSession):
    """Files are read in parts of ``SPLIT`` bytes and written with row groups of that size (a part of a file is rows only if
    it holds a row group), so that tasks stay many and alike however few files the input has."""
    settings = {"spark.sql.files.maxPartitionBytes": f"{SPLIT}b", "parquet.block.size": str(SPLIT)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_counts(df: DataFrame, text: str, max_terms: int = 512, num_features: int = 1 << 16, by: str | None = None) -> DataFrame:
    """``term_counts`` written and read back. A task's rows are laid by the label ``by``: neighbours then share more terms,
    and the passes of a fit find more of its weights (labels x features) in the processor's cache."""
    counts = term_counts(df, text, max_terms, num_features)
    with _split(df.sparkSession):
        return cut_lineage(counts.sortWithinPartitions(by) if by else counts)


def label_names(df: DataFrame, label: str, max_labels: int) -> tuple[list[str], Column]:
    """The distinct labels in ascending order and a row's place among them."""
    labels = sorted(r[0] for r in df.where(F.col(label).isNotNull()).select(label).distinct().limit(max_labels + 1).collect())
    if not 2 <= len(labels) <= max_labels:
        raise ValueError(f"{len(labels)} labels; 2 to {max_labels} can be told apart")
    return labels, F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)).cast("double") - 1


def fit_labels(df: DataFrame, text: str, label: str, max_terms: int = 512, num_features: int = 1 << 16, max_iter: int = 30,
               reg: float = 0.01, max_labels: int = 1000) -> LabelModel:
    """M1-M3 trained where labels exist: multinomial logistic regression over hashed terms, one class for each distinct
    label in ascending order. Rows without a label are not used. ``max_labels`` bounds the model (labels x features
    in the driver); more labels are an error."""
    labels, index = label_names(df, label, max_labels)
    labelled = df.where(F.col(label).isNotNull()).select(F.col(text).alias("__text"), index.alias("__label"))
    # the fits read it many times: texts are cut into terms and hashed once, only the sparse counts are kept
    train = stored_counts(labelled, "__text", max_terms, num_features, "__label").select("__tf", "__label")
    return _fit(train, labels, max_terms, num_features, max_iter, reg)


def fit_counts(counts: DataFrame, label: str, max_terms: int = 512, num_features: int = 1 << 16, max_iter: int = 30,
               reg: float = 0.01, max_labels: int = 1000) -> LabelModel:
    """``fit_labels`` over rows of ``stored_counts`` (made with the same limits), which scoring can use too."""
    labels, index = label_names(counts, label, max_labels)
    train = counts.where(F.col(label).isNotNull()).select("__tf", index.alias("__label"))
    return _fit(train, labels, max_terms, num_features, max_iter, reg)


def _fit(train: DataFrame, labels: list[str], max_terms: int, num_features: int, max_iter: int, reg: float) -> LabelModel:
    with _split(train.sparkSession):
        idf = IDF(inputCol="__tf", outputCol="__features").fit(train)
        # a block costs a pass over labels x features besides its rows, so blocks hold many rows
        fitted = LogisticRegression(featuresCol="__features", labelCol="__label", family="multinomial", maxIter=max_iter, regParam=reg,
                                    probabilityCol="__prob", predictionCol="__pred", rawPredictionCol="__raw",
                                    maxBlockSizeInMB=BLOCK_MB).fit(idf.transform(train).select("__features", "__label"))
    tf = HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features)
    return LabelModel(PipelineModel([tf, idf, fitted]), labels, max_terms)


def add_toxicity_model(df: DataFrame, model: PipelineModel, text: str = "speech",
                       out: str = "toxicity_model", prob_out: str | None = None) -> DataFrame:
    """M5: label from a trained toxicity classifier (+ its probability)."""
    return label_from_model(model, df, text, ["not toxic", "toxic"], out, prob_out)
