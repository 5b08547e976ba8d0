"""E4 against brute force: clustered, equal, opposite and zero vectors, ties, several groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.operators import nearest


def brute(rows, k):
    good = [(i, np.asarray(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v)
            and None not in v and np.isfinite(np.asarray(v, dtype=float)).all() and np.abs(np.asarray(v, dtype=float)).max() > 0]
    u = np.array([v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for _, v in good])
    sim = np.minimum(np.round(u @ u.T, 6), 1.0) + 0.0
    out = set()
    for a, (i, _) in enumerate(good):
        best = sorted(((-sim[a, b], j) for b, (j, _) in enumerate(good) if j != i))[:k]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def vectors(n=700, dim=8, seed=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(9, dim))
    rows = [(int(i), (centres[i % 9] + rnd.normal(scale=0.15, size=dim)).tolist()) for i in range(n)]
    rows += [(n + i, rows[i % 3][1]) for i in range(40)]  # equal vectors
    rows += [(n + 100 + i, [2.0 * x for x in rows[5][1]]) for i in range(4)]  # equal directions
    rows += [(n + 200, [0.0] * dim), (n + 201, None), (n + 202, [1.0, None] + [0.0] * (dim - 2)),
             (n + 203, [float("nan")] + [1.0] * (dim - 1)), (n + 204, [1e300] * dim), (n + 205, [-1e-300] * dim),
             (n + 206, [1.0] + [0.0] * (dim - 1)), (n + 207, [0.0, 1.0] + [0.0] * (dim - 2))]
    return rows


@pytest.mark.parametrize("pivots, group", [(6, 90), (64, 16384), (1, 50)])
def test_equal_to_brute_force(spark, pivots, group):
    rows = vectors()
    df = spark.createDataFrame(rows, "id long, e array<double>").withColumn("v", F.lit(1)).withColumn("rid", F.lit("x")).repartition(5)
    got = {(r.id, r.rank, r.neighbour_id, r.similarity) for r in nearest.nearest_vectors(df, "id", "e", 4, pivots, group).collect()}
    assert got == brute(rows, 4)


def test_few_rows_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, e array<double>")
    got = {(r.id, r.rank, r.neighbour_id, r.similarity) for r in nearest.nearest_vectors(df, "id", "e", 10).collect()}
    assert got == brute(rows, 10) and len(got) == 6
    assert nearest.nearest_vectors(df.limit(0), "id", "e").count() == 0
    assert nearest.nearest_vectors(df.limit(1), "id", "e").count() == 0
    with pytest.raises(ValueError):
        nearest.nearest_vectors(df.unionAll(spark.createDataFrame([(9, [1.0])], df.schema)), "id", "e")


def test_a_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i % 7), 1.0, float(i % 5)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, e array<double>")
    got = {(r.id, r.rank, r.neighbour_id, r.similarity) for r in nearest.nearest_vectors(df, "id", "e", 3, 5, 20).collect()}
    assert got == brute(rows, 3)


def test_plan_has_no_nested_loop_join(spark):
    df = spark.createDataFrame(vectors(200), "id long, e array<double>")
    plan = nearest.nearest_vectors(df, "id", "e")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_bounds_keep_well_separated_rows_at_home():
    """A row of one tight cluster reaches no cell of another: rings and planes cut the rest off."""
    rnd = np.random.default_rng(1)
    centre = np.eye(6)
    v = np.repeat(centre, 50, axis=0) + rnd.normal(scale=0.01, size=(300, 6))
    v /= np.linalg.norm(v, axis=1)[:, None]
    d = nearest._distances(v, centre)
    cell = d.argmin(axis=1) * (nearest.RINGS + 1) + (d.min(axis=1) * (nearest.RINGS / 2)).astype(int)

    class Stat:
        def __init__(self, c):
            near = d.min(axis=1)[cell == c]
            self.cell, self.n, self.lo, self.hi = c, len(near), near.min(), near.max()
    cells = nearest.Cells(centre, [Stat(c) for c in np.unique(cell)], 40)
    reach = cells.reach(v, np.full(300, 0.05))
    assert (cells.pivot[np.nonzero(reach)[1]] == np.repeat(np.arange(6), 50)[np.nonzero(reach)[0]]).all()
    assert reach[np.arange(300), np.searchsorted(cells.cell, cell)].all()
