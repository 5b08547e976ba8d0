"""Session helpers that carry the scale decisions, and the oracle's independence of local files."""

import contextlib
import io

import pytest

from oratio.operators.profiles import add_profiles
from oratio.session import SCAN_PARTITIONS, cut_lineage, ensure_checkpoint_dir, spread


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_spread_follows_the_setting_only(spark):
    df = spark.range(0, 100, numPartitions=3)
    before = spark.conf.get(SCAN_PARTITIONS)
    try:
        spark.conf.set(SCAN_PARTITIONS, "5")
        assert spread(df, "id").rdd.getNumPartitions() == 5
        spark.conf.unset(SCAN_PARTITIONS)
        assert spread(df, "id") is df
    finally:
        spark.conf.set(SCAN_PARTITIONS, before)


def test_join_form_is_left_to_the_planner(spark):
    facts = spark.range(1000).selectExpr("CAST(id % 7 AS STRING) AS surname", "id")
    dim = spark.range(7).selectExpr("CAST(id AS STRING) AS surname", "id * 10 AS v")
    assert "rightHint" not in plan_text(add_profiles(facts, dim))


def test_missing_checkpoint_folder_is_an_error(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getConf = staticmethod(lambda: Session.conf)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)


def test_oracle_texts_need_no_spark_files(monkeypatch):
    import glob
    import zipfile

    def refuse(*_a, **_k):
        raise FileNotFoundError
    monkeypatch.setattr(zipfile, "ZipFile", refuse)
    monkeypatch.setattr(glob, "glob", lambda *_a, **_k: [])
    import __spark_entry__
    from oratio.plans.oracle import ORACLE
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_stop_words_equal_spark_ml(spark):
    from pyspark.ml.feature import StopWordsRemover

    from oratio.functions.lexicons import stop_words
    assert list(stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_cut_lineage_reads_back_from_checkpoint_folder(spark):
    df = spark.range(50).selectExpr("id", "id * id AS sq")
    cut = cut_lineage(df)
    assert sorted(cut.collect()) == sorted(df.collect())
    assert ensure_checkpoint_dir(spark).rstrip("/") in plan_text(cut)
