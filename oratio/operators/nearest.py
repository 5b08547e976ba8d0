"""Nearest vectors (E4): an exact k-nearest-neighbour join by cosine similarity, in metric space.

Vectors are scaled to length one, so the greatest cosine is the least Euclidean distance and the triangle
inequality holds. Equal directions become one row that keeps its least ids. Every row goes to its nearest
pivot (a Voronoi cell) and to a ring of distance from it; the number of cells is bounded by the pivots, their
counts and least and greatest distances fit the driver at any table size. Cells are put together to groups of about
``GROUP`` rows, larger cells are dealt over several groups.

First pass: the rows of a group, in the order of cell and distance, are compared in pieces; the k-th nearest
found bounds each row's search. Second pass: a row travels to those groups only that hold a cell its bound
reaches, by the distance to the cell's pivot against the ring and by the distance to the plane between the two
pivots. There it is compared with the cells within reach; the k best of each group visited are ranked.

A task holds one group and one batch of visitors. How many groups a row visits depends on the data: well
separated directions visit few, uniformly spread ones of many dimensions visit most, as in any exact method.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PIVOTS = 64
SAMPLE = 2048  # rows the pivots are chosen from: those of the least id hash
GROUP = 16384
RINGS = 32  # rings of width 2 / RINGS: distances of unit vectors lie in 0..2
PIECE = 1024
PLACES = 6
SLACK = 2e-6  # of the cosine: ties after rounding are found whatever the last digits


def unit_vectors(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v): vectors scaled to length one. Null or zero vectors and those with null, NaN or infinite components
    have no direction and are left out; components are scaled by the greatest first, so no square overflows."""
    d = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    usable = F.expr("size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    d = d.where("id IS NOT NULL AND v IS NOT NULL").where(usable)
    d = d.withColumn("m", F.expr("array_max(transform(v, x -> abs(x)))")).where("m > 0")
    d = d.select("id", F.expr("transform(v, x -> x / m)").alias("v"))
    norm = F.expr("sqrt(aggregate(v, 0D, (s, x) -> s + x * x))")
    return d.withColumn("n", norm).select("id", F.expr("transform(v, x -> x / n + 0D)").alias("v"))


def _directions(units: DataFrame, keep: int) -> DataFrame:
    """(rid, v, ids): one row a direction, with its ``keep`` least ids. The window keeps that many rows a direction before
    the shuffle, so a direction that a third of the rows share costs little."""
    w = Window.partitionBy("v").orderBy("id")
    few = units.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep)
    return few.groupBy("v").agg(F.min("id").alias("rid"), F.sort_array(F.collect_list("id")).alias("ids")).select("rid", "v", "ids")


def choose_pivots(rows: DataFrame, pivots: int, sample: int) -> np.ndarray:
    """Pivots far from one another among the ``sample`` rows of the least hash (bounded, the same in every run)."""
    some = rows.select("v").orderBy(F.xxhash64("rid"), "rid").limit(sample).toPandas()["v"]
    v = np.array([np.asarray(x, dtype=float) for x in some])
    chosen, far = [0], np.full(len(v), np.inf)
    while len(chosen) < min(pivots, len(v)):
        far = np.minimum(far, ((v - v[chosen[-1]]) ** 2).sum(axis=1))
        if far.max() < 1e-12:
            break
        chosen.append(int(far.argmax()))
    return v[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * a @ b.T, 0))


def _vectors(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Cells:
    """Where rows lie and which groups a search must visit: pivots, and for each (pivot, ring) cell its least and
    greatest distance, first group and number of groups."""

    def __init__(self, pivots: np.ndarray, stats, group: int):
        self.pivots, self.between = pivots, _distances(pivots, pivots)
        self.cell = np.array([s.cell for s in stats])
        self.pivot = self.cell // (RINGS + 1)
        self.lo, self.hi = np.array([s.lo for s in stats]), np.array([s.hi for s in stats])
        first, parts, at, fill = [], [], 0, 0
        for s in stats:
            if s.n > group:  # a large cell has groups of its own
                at += fill > 0
                first.append(at), parts.append(-(-s.n // group))
                at, fill = at + parts[-1], 0
                continue
            if fill + s.n > group:
                at, fill = at + 1, 0
            first.append(at), parts.append(1)
            fill += s.n
        self.first, self.parts = np.array(first), np.array(parts)

    def group_of(self, cell: np.ndarray, salt: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.cell, cell)
        return self.first[k] + salt % self.parts[k]

    def reach(self, v: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Rows x cells: whether the cell may hold a vector within ``bound`` of the row."""
        d = _distances(v, self.pivots)
        own = d.argmin(axis=1)
        near = d[np.arange(len(v)), own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d ** 2 - near[:, None] ** 2) / (2 * self.between[own])
        plane[np.arange(len(v)), own] = 0
        reach = bound[:, None] + 1e-9
        ring = (d[:, self.pivot] + reach >= self.lo) & (d[:, self.pivot] - reach <= self.hi)
        return ring & (plane[:, self.pivot] <= reach)


def _by_group(df: DataFrame, order: list[str], work, schema: str) -> DataFrame:
    """``work(batches)`` of each group's rows in the given order, streamed."""
    def run(batches):
        group, held = None, []

        def parts():
            for b in batches:
                g = b.column(0).to_numpy()
                cut = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1), b.num_rows]
                for lo, hi in zip(cut, cut[1:]):
                    if hi > lo:
                        yield int(g[lo]), b.slice(lo, hi - lo)
        for g, part in parts():
            if held and g != group:
                yield from work(held)
                held = []
            group = g
            held.append(part)
        if held:
            yield from work(held)

    return df.repartition("g").sortWithinPartitions("g", *order).mapInArrow(run, schema)


def nearest_vectors(df: DataFrame, id_col: str, vec: str, k: int = 5, pivots: int = PIVOTS, group: int = GROUP) -> DataFrame:
    """For every vector its ``k`` nearest others: (id, rank, neighbour_id, similarity), similarity being the
    cosine rounded to 6 places, greatest first, ties to the lesser id. Exact. Rows without a direction take no part; all others must
    have one length (ValueError otherwise). A repeated id counts once a direction."""
    units = cut_lineage(unit_vectors(df, id_col, vec))
    reps = cut_lineage(_directions(units, k + 1))
    sizes = reps.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if sizes.lo != sizes.hi:
        raise ValueError(f"vectors of {sizes.lo} to {sizes.hi} components")
    if sizes.lo is None:
        pairs = reps.select("rid", F.col("rid").alias("near"), F.lit(1.0).alias("sim"))
    else:
        pairs = _search(reps, sizes.lo, k, pivots, group)

    # a direction's ids with those of its nearest directions, its own included
    ids = reps.select(F.col("rid").alias("near"), "ids")
    listed = pairs.join(ids, "near").select("rid", "sim", F.explode("ids").alias("neighbour_id"))
    w = Window.partitionBy("rid").orderBy(F.col("sim").desc(), "neighbour_id")
    best = (listed.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
            .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("r", "neighbour_id", "sim"))).alias("best")))
    rows = units.join(reps.select("v", "rid"), "v").select("id", "rid").distinct().join(best, "rid")
    others = F.slice(F.filter("best", lambda b: b["neighbour_id"] != F.col("id")), 1, k)
    out = rows.select("id", F.posexplode(others).alias("at", "b"))
    return out.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("rank"), F.col("b.neighbour_id").alias("neighbour_id"),
                      F.col("b.sim").alias("similarity"))


def _search(reps: DataFrame, dim: int, k: int, pivots: int, group: int) -> DataFrame:
    """(rid, near, sim): the k + 1 nearest directions of each direction, itself first."""
    centre = choose_pivots(reps, pivots, SAMPLE)

    def place(batches):
        for b in batches:
            if b.num_rows:
                d = _distances(_vectors(b.column(1), dim), centre)
                own = d.argmin(axis=1)
                near = d[np.arange(len(d)), own]
                cell = own * (RINGS + 1) + np.minimum((near * (RINGS / 2)).astype(np.int64), RINGS)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64()), pa.array(near)],
                                                 names=["rid", "v", "salt", "cell", "near"])

    id_type = dict(reps.dtypes)["rid"]
    dealt = cut_lineage(reps.select("rid", "v", F.expr("xxhash64(rid) & 9007199254740991").alias("salt")).mapInArrow(
        place, f"rid {id_type}, v array<double>, salt long, cell long, near double"))
    cells = Cells(centre, dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("lo"),
                                                    F.max("near").alias("hi")).orderBy("cell").collect(), group)

    def grouped(batches):
        for b in batches:
            if b.num_rows:
                g = cells.group_of(b.column(3).to_numpy(), b.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), *b.columns], names=["g", "rid", "v", "salt", "cell", "near"])

    own = dealt.mapInArrow(grouped, f"g long, rid {id_type}, v array<double>, salt long, cell long, near double")

    def bound(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        v = _vectors(t.column(2).combine_chunks(), dim)
        out = np.full(len(v), 3.0)  # beyond all distances: visits everything
        for at in np.array_split(np.arange(len(v)), max(1, len(v) // PIECE)):
            if len(at) > k:
                kth = -np.partition(-(v[at] @ v[at].T), k, axis=1)[:, k]
                out[at] = np.sqrt(np.maximum(2 - 2 * (kth - SLACK), 0))
        yield from t.select(["g", "rid", "v", "cell"]).append_column("reach", pa.array(out)).to_batches()

    bounded = cut_lineage(_by_group(own, ["cell", "near", "rid"], bound, f"g long, rid {id_type}, v array<double>, cell long, reach double"))

    def visits(batches):
        for b in batches:
            for lo in range(0, b.num_rows, PIECE):
                part = b.slice(lo, PIECE)
                r, c = np.nonzero(cells.reach(_vectors(part.column(1), dim), part.column(2).to_numpy()))
                n = cells.parts[c]
                r, g = np.repeat(r, n), np.repeat(cells.first[c], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                once = np.unique(np.stack([g, r], axis=1), axis=0)  # a group once, however many of its cells are reached
                yield pa.RecordBatch.from_arrays([pa.array(once[:, 0], pa.int64()), *part.take(pa.array(once[:, 1])).columns],
                                                 names=["g", "rid", "v", "reach"])

    guests = bounded.select("rid", "v", "reach").mapInArrow(visits, f"g long, rid {id_type}, v array<double>, reach double")
    both = bounded.select("g", F.lit(0).alias("kind"), "cell", "rid", "v", "reach").unionAll(
        guests.select("g", F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("cell"), "rid", "v", "reach"))

    def compare(batches):
        group_, mine, names, where = None, [], [], []
        for b in batches:
            g, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            cut = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (kind[1:] != kind[:-1])) + 1), b.num_rows]
            for lo, hi in zip(cut, cut[1:]):
                if hi == lo:
                    continue
                part = b.slice(lo, hi - lo)
                if g[lo] != group_:
                    group_, mine, names, where = g[lo], [], [], []
                if kind[lo] == 0:
                    mine.append(_vectors(part.column(4), dim)), names.append(part.column(3).to_numpy(zero_copy_only=False))
                    where.append(part.column(2).to_numpy())
                    continue
                if len(mine) > 1:
                    mine, names, where = [np.concatenate(mine)], [np.concatenate(names)], [np.concatenate(where)]
                for at in range(0, part.num_rows, PIECE):
                    yield _best(cells, part.slice(at, PIECE), mine[0], names[0], where[0], dim, k)

    found = both.repartition("g").sortWithinPartitions("g", "kind", "cell").mapInArrow(
        compare, f"rid {id_type}, near {id_type}, sim double")
    w = Window.partitionBy("rid").orderBy(F.col("sim").desc(), "near")
    return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).select("rid", "near", "sim")


def _best(cells: Cells, guests, mine: np.ndarray, names: np.ndarray, where: np.ndarray, dim: int, k: int):
    """The k + 1 best rows of a group for each guest, ties to the lesser id, over the cells within the guest's reach."""
    v = _vectors(guests.column(4), dim)
    reach = cells.reach(v, guests.column(5).to_numpy())
    rows, cols, sims = [], [], []
    edges = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1), len(where)]
    for lo, hi in zip(edges, edges[1:]):
        need = np.flatnonzero(reach[:, np.searchsorted(cells.cell, where[lo])])
        for a in range(lo, hi, 4 * PIECE):
            z = min(a + 4 * PIECE, hi)
            if len(need):
                s = np.round(v[need] @ mine[a:z].T, PLACES) + 0.0
                if z - a > k + 1:
                    kth = -np.partition(-s, k, axis=1)[:, k]
                    r, c = np.nonzero(s >= kth[:, None])
                else:
                    r, c = (x.ravel() for x in np.indices(s.shape))
                rows.append(need[r]), cols.append(c + a), sims.append(s[r, c])
    if not rows:
        return pa.RecordBatch.from_arrays([guests.column(3).slice(0, 0), pa.array(names[:0]), pa.array([], pa.float64())],
                                          names=["rid", "near", "sim"])
    r, c, s = np.concatenate(rows), np.concatenate(cols), np.minimum(np.concatenate(sims), 1.0)
    order = np.lexsort((names[c], -s, r))
    r, c, s = r[order], c[order], s[order]
    first = np.searchsorted(r, r)  # r is sorted: where each guest's candidates begin
    top = np.arange(len(r)) - first <= k
    return pa.RecordBatch.from_arrays([guests.column(3).take(pa.array(r[top])), pa.array(names[c[top]]), pa.array(s[top])],
                                      names=["rid", "near", "sim"])
