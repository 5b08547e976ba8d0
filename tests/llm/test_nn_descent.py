"""Neighbour search: the beam follows the recall that a run measures, and a walk that cannot reach it is an error."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.llm import nn_descent


def nearest_ids(x, q, k):
    d = ((x - x[q]) ** 2).sum(axis=1)
    return [j for j in np.lexsort((np.arange(len(x)), d)).tolist() if j != q][:k]


def test_beam_grows_until_the_recall_is_met(spark):
    x = np.random.default_rng(5).standard_normal((3000, 48)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(df, F.expr("id % 50 = 0"), degree=4, rounds=1, beam=11).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & set(nearest_ids(x, q, 10))) for q in range(0, 3000, 50))
    assert hits >= 0.93 * 10 * 60


def test_unreachable_neighbours_are_an_error(spark):
    x = np.random.default_rng(6).standard_normal((400, 8)).astype("<f4")
    vectors = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, v binary")
    codes = nn_descent.leaf_codes(vectors, 400, 1, 400)
    graph = spark.createDataFrame([(0, 1, 1.0)], "id long, nbr long, d float")  # hardly an edge
    queries = vectors.where("id % 40 = 0").select(F.col("id").alias("qid"), F.col("v").alias("qv"))
    with pytest.raises(RuntimeError, match="nearest"):
        nn_descent.search(queries, vectors, codes, codes.where("id % 40 = 0"), graph, 10)


def test_queries_in_a_large_group_get_the_smallest_ids(spark):
    x = np.random.default_rng(7).standard_normal((5000, 16)).astype(np.float32).astype(np.float64)
    x[1000:4000] = x[1000]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in nn_descent.nearest(df, F.expr("id % 200 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 5000, 200))
    for q in range(1000, 4000, 200):
        assert got[q] == nearest_ids(x, q, 10)
    hits = sum(len(set(got[q]) & set(nearest_ids(x, q, 10))) for q in got)
    assert hits >= 0.95 * 10 * len(got)


def test_components_beyond_single_precision(spark):
    x = np.random.default_rng(8).standard_normal((600, 16)) * 1e60
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(df, F.expr("id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float(np.linalg.norm(x[r.vec_id] - x[r.query_id])))
    assert sum(len(set(got[q]) & set(nearest_ids(x, q, 10))) for q in range(0, 600, 50)) >= 0.95 * 10 * 12


def test_only_the_sample_walks_until_the_beam_is_found(spark, caplog):
    x = np.random.default_rng(9).standard_normal((2000, 32)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    with caplog.at_level("INFO", logger=nn_descent.__name__):
        got = {}
        for r in nn_descent.nearest(df, F.expr("id % 10 = 0"), degree=6, rounds=1, beam=20).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
    walks = [r.args[0] for r in caplog.records if "walks took" in r.msg]
    assert len(walks) > 2 and walks[-1] == 200 - nn_descent.SAMPLE  # the others walk once
    assert all(n % nn_descent.SAMPLE == 0 for n in walks[:-1])
    assert sum(len(got[q] & set(nearest_ids(x, q, 10))) for q in range(0, 2000, 10)) >= 0.93 * 10 * 200


def test_nearest_of_a_row_are_those_of_a_sort():
    d = np.random.default_rng(10).integers(0, 40, (50, 900)).astype(np.float32)
    at, near = nn_descent._nearest_of(d, 24)
    assert (np.sort(near, axis=1) == np.sort(d, axis=1)[:, :24]).all()
    assert (np.take_along_axis(d, at, 1) == near).all() and all(len(set(r)) == 24 for r in at.tolist())


def test_parcels_reach_their_blocks_whole():
    rng = np.random.default_rng(11)
    ids, block = np.arange(10_000), rng.integers(0, 3, 10_000)
    x = rng.standard_normal((10_000, 5)).astype("<f4")
    b = nn_descent._sent(nn_descent.VECTOR, block, ids, x, x[:, 0])
    for one in range(3):
        rows = [r for r, to in zip(nn_descent._received([b]), b.column("block").to_pylist()) if to == one]
        got, y, _ = nn_descent._arrived(rows, nn_descent.VECTOR)
        assert got.tolist() == np.flatnonzero(block == one).tolist() and (y == x[got]).all()
        assert max(len(r[1].as_buffer()) for r in rows) <= 8 * nn_descent.ITEMS
