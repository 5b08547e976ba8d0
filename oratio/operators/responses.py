"""Model responses: latest response per speech, `$`-field parsing, join, extraction."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lexicons import RESPONSE_FIELDS
from ..session import cut_lineage
from ..sources.tables import table

FIELDS = RESPONSE_FIELDS
N_FIELDS = len(FIELDS)


def responses_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A responses table over the driver tables: every document answered with a `$`-joined
    record whose last field is its own text (so `$` inside texts shifts fields, as it would)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("text").alias("speech"),
                    F.concat_ws("$", "source", "lang", F.col("n_chars").cast("string"), "text").alias("response"),
                    F.col("doc_id").alias("seq"))


def _key(speech: str):
    """Columns that stand for a speech text in a join: a hash, the length, and the MD5 digest that confirms them."""
    return [F.xxhash64(speech).alias("__h"), F.length(speech).alias("__n"), F.md5(speech).alias("__m")]


def latest_responses(responses: DataFrame) -> DataFrame:
    """J3 dedup: one response per speech text, the highest ``seq`` wins (later answers replace earlier ones; of equal
    ``seq`` the response of the greatest hash, then text; rows without ``seq`` never). Rows (__h, __n, __m, speech, response).

    The winner is the first row of a window over the key, ordered by numbers: every map task keeps its best row of a text
    before the one shuffle, so the many answers of a popular text travel as one row a task, and the join by the same
    key needs no further shuffle of the responses. Columns that the join does not use, as the text, do not travel."""
    keyed = responses.where("seq IS NOT NULL AND speech IS NOT NULL").select(*_key("speech"), "seq", "speech", "response")
    best = Window.partitionBy("__h", "__n", "__m").orderBy(F.col("seq").desc(), F.xxhash64("response").desc(), F.col("response").desc())
    return keyed.withColumn("__r", F.row_number().over(best)).where(F.col("__r") == 1).drop("__r", "seq")


def parse_responses(df: DataFrame, col: str = "response") -> DataFrame:
    """X1+X2: split on `$`, pad with ``N/A`` to eight, cut to eight; ``fields_found`` is the
    number of parts; in the narrative field ``;`` becomes a blank line."""
    parts = F.split(F.col(col), r"\$", -1)
    padded = F.slice(F.concat(F.coalesce(parts, F.array().cast("array<string>")),
                              F.array_repeat(F.lit("N/A"), N_FIELDS)), 1, N_FIELDS)
    out = df.withColumn("__parts", padded)
    for i, name in enumerate(FIELDS):
        v = F.col("__parts")[i]
        if name == "underlying_narrative":
            v = F.replace(v, F.lit(";"), F.lit("\n\n"))
        out = out.withColumn(name, v)
    found = F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.size(parts))  # size(null) is -1, not null
    return out.withColumn("fields_found", found.cast("bigint")).drop("__parts")


def add_responses(df: DataFrame, latest: DataFrame, speech: str = "speech") -> DataFrame:
    """Attach the latest response by speech text (left join; missing -> eight ``N/A``). ``latest``: of
    ``latest_responses``."""
    keys = ("__h", "__n", "__m")
    joined = df.select("*", *_key(speech)).join(latest.select(*keys, "response"), list(keys), "left")
    return parse_responses(joined.drop(*keys), "response").drop("response")


def _asked(pairs: DataFrame, complete: Callable[[str | None, str], str]) -> DataFrame:
    """(name, speech, response, error, seq): one call for each row of ``pairs`` (name, speech, seq)."""
    def run(it):
        for pdf in it:
            resp, err = [], []
            for n, s in zip(pdf["name"], pdf["speech"]):
                try:
                    resp.append(complete(n, s))
                    err.append(None)
                except Exception as e:  # per-row failure, the batch goes on
                    resp.append(None)
                    err.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"name": pdf["name"].values, "speech": pdf["speech"].values, "response": resp,
                                "error": err, "seq": pdf["seq"].values})

    return pairs.mapInPandas(run, ANSWER)


ANSWER = "name string, speech string, response string, error string, seq bigint"


def _pairs(df: DataFrame, name: str, speech: str, id_col: str, partitions: int | None) -> DataFrame:
    pairs = (df.groupBy(F.col(name).alias("name"), F.col(speech).alias("speech"))
             .agg(F.max(id_col).cast("bigint").alias("seq")))
    return pairs.repartition(partitions) if partitions else pairs


def extract_with(df: DataFrame, complete: Callable[[str | None, str], str], name: str = "full_name",
                 speech: str = "speech", id_col: str = "speech_id", partitions: int | None = None,
                 materialize: bool = True) -> DataFrame:
    """M7: one call of ``complete(name, speech)`` per distinct (name, speech), spread over
    partitions; errors become a per-row ``error`` column instead of failing the job. The result
    is a responses table (name, speech, response, error, seq) for J3. With ``materialize`` (default)
    it is written to the checkpoint folder once, so later stages, retries and lost executors
    never call the model again for rows already answered.

    ``seq`` is the highest ``id_col`` of each (name, speech), so of two names asking about one
    speech the later input row wins, whatever the partitioning. Failed calls keep their row here
    (with ``error``); ``usable_responses`` drops them before J3."""
    out = _asked(_pairs(df, name, speech, id_col, partitions), complete)
    return cut_lineage(out) if materialize else out


def stored_answers(spark: SparkSession, store: str) -> DataFrame | None:
    """All generations of a response store: the columns of ``extract_with`` and ``generation``; None before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{store.rstrip('/')}/generation=*/_SUCCESS"))
    if not found:
        return None
    done = [str(f.getPath().getParent()) for f in found]  # a generation whose job did not end is not read
    return spark.read.schema(ANSWER + ", generation bigint").option("basePath", store).parquet(*done)


def extract_missing(df: DataFrame, store: str, complete: Callable[[str | None, str], str], name: str = "full_name",
                    speech: str = "speech", id_col: str = "speech_id", partitions: int | None = None) -> DataFrame:
    """M7, one run of many: the pairs (name, speech) of ``df`` without an answer in the ``store`` folder are asked, failed
    ones again, answered ones never, and appended to the store as its next generation. Returns the whole store.

    A run that is cut off leaves an unfinished generation, which is not read and is written anew by the next run.
    Which pairs to ask is settled on numbers: 128 bits of hash of (name, text), null names included, and the highest id;
    the texts of those rows alone are then fetched. Ids must not be null."""
    spark = df.sparkSession
    before = stored_answers(spark, store)
    key = [F.xxhash64(name, speech).alias("__a"), F.xxhash64(F.lit(1), name, speech).alias("__b")]
    todo = df.select(*key, F.col(id_col).cast("bigint").alias("seq")).groupBy("__a", "__b").agg(F.max("seq").alias("seq"))
    number = 0
    if before is not None:
        number = before.agg(F.max("generation")).first()[0]
        number = 0 if number is None else number + 1
        answered = before.where("error IS NULL").select(F.xxhash64("name", "speech").alias("__a"),
                                                        F.xxhash64(F.lit(1), "name", "speech").alias("__b")).distinct()
        todo = todo.join(answered, ["__a", "__b"], "left_anti")
    one = Window.partitionBy("__a", "__b").orderBy("__a")  # an id that stands twice asks once
    rows = df.select(*key, F.col(name).alias("name"), F.col(speech).alias("speech"), F.col(id_col).cast("bigint").alias("seq"))
    pairs = (rows.join(todo, ["__a", "__b", "seq"]).withColumn("__r", F.row_number().over(one)).where(F.col("__r") == 1)
             .select("name", "speech", "seq"))
    asked = _asked(pairs.repartition(partitions) if partitions else pairs, complete)
    asked.write.mode("overwrite").parquet(f"{store.rstrip('/')}/generation={number}")
    return stored_answers(spark, store)


def usable_responses(extracted: DataFrame) -> DataFrame:
    """The answered rows of ``extract_with`` or ``extract_missing`` as (speech, response, seq); a failed call never replaces
    an answer. Of a store, a later generation wins over an earlier one, then the higher id: ``seq`` orders by both."""
    seq = F.col("seq")
    if "generation" in extracted.columns:
        seq = (F.col("generation").cast("decimal(18,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)") + F.col("seq")).cast("decimal(38,0)")
    return extracted.where(F.col("error").isNull()).select("speech", "response", seq.alias("seq"))
