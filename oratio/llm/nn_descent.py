"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Build. Trees of hyperplanes (directions between sampled vectors, cut at the sample's medians) deal the vectors to leaves; the
nearest within a leaf start a graph of ``DEGREE`` neighbours per vector. Each round joins neighbours of neighbours: every
vector gathers its neighbours and a bounded sample of those that point at it, compares the pairs that hold a new edge, and
proposes to each the others that are nearer than its worst neighbour; the best ``DEGREE`` stay. Rounds end when few edges
change; a graph that has not settled after ``ROUNDS`` is logged (the search measures what it is worth).

Search. A query enters at itself and at members of its leaves and walks: the best unexpanded nodes of its beam are
expanded through the graph (forward and sampled backward edges), new nodes are measured, until the whole beam is
expanded. Each run measures its own recall: a hashed sample of the queries walks first and is compared with all vectors.
Beams grow by half until the sample finds ``TARGET`` of the nearest, then the other queries walk, once, with the beam that
did; a beam as large as the table that still misses the target is an error. Walks do not depend on each other, so
the sample's recall is that of the walks with this beam. Results are measured again on the original vectors in double precision.

Equal vectors are one node, the least id of them. The walks are made once for each distinct query vector; at the end a node
stands for its members with the smallest ids, as many as a result can hold.

Scale: nodes are numbered in the order of a tree's leaves, and equal ranges of numbers are blocks of about ``BLOCK`` bytes of vectors, so that
neighbours often share a block. What moves between tasks are parcels, rows that hold arrays for one block: a vector goes
once to each block that joins it, a hop's candidates go to the block that holds their vectors and come back only if they are nearer
than the beam's worst. A task holds its block and what it was sent: at most ``2 * DEGREE`` vectors for each of its nodes in a
round. Walks are one row (vector, beam) each; what a walk has met and rejected is not remembered (it is nearer than
nothing in the beam). Leaves beyond ``LEAF_MOST`` members are joined in parts, and pointers from hubs are sampled by a
rank limit (both only steer the graph, every vector is a node of it). On the driver are a sample of vectors for the hyperplanes, the
queries of the recall's sample and a number a block.

The graph and the walks use single precision after scaling by a power of two to components of at most 1, so that large
components cannot overflow.

Defined cases: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components are neither nodes nor queries; rows of one id count once (least vector in
array order); ties go to the smaller id; with fewer candidates than asked for all are returned; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, release

DEGREE = 24
REVERSE = 24
TREES = 12
LEAF = 4096
LEAF_MOST = 8192
FOREST = 8192  # vectors from which the hyperplanes are drawn, fewer if they are long
ROUNDS = 12
SETTLED = 0.02
BEAM = 320  # at first; grows while the measured recall is below TARGET
EXPAND = 5  # a hop expands this part of the beam
SAMPLE = 128  # queries whose recall is measured in each run
TARGET = 0.95  # the required recall is 0.9; the sample's error lies well within the difference
ENTRIES = 2
SEED = 11
BUFFER = 1_000_000  # proposals that a task merges before it hands them on
BLOCK = 6_000_000  # bytes of a block's vectors
LEAST = 1024  # vectors of a block, if that leaves no core without one
ITEMS = 4096  # items of a parcel


def usable_vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, exact, v): one row per id with a usable vector; ``v`` holds float32 bytes for the graph, scaled to at most 1."""
    v = F.col(vector).cast("array<double>")
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("exact"))

    def usable(b):
        """(which rows are usable, their lengths, all components, where rows begin)"""
        off = b.column("exact").offsets.to_numpy()
        flat = b.column("exact").values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]  # a null becomes NaN
        off = off - off[0]
        odd, some = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(flat), flat != 0))
        return (odd[off[1:]] == odd[off[:-1]]) & (some[off[1:]] > some[off[:-1]]), np.diff(off), flat, off[:-1]

    def sizes(batches):
        for b in batches:
            ok, n, flat, begin = usable(b)
            if ok.any():
                size, row = np.unique(n[ok], return_inverse=True)
                most = np.zeros(len(size))
                np.maximum.at(most, row, np.maximum.reduceat(np.abs(flat), begin[n > 0])[ok[n > 0]])
                yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int32)), pa.array(np.bincount(row)), pa.array(most)], names=["n", "c", "most"])

    size = (rows.mapInArrow(sizes, "n int, c long, most double").groupBy("n").agg(F.sum("c").alias("c"), F.max("most").alias("most"))
            .orderBy(F.desc("c"), "n").limit(1).collect())
    width, shift = (size[0].n, -math.frexp(size[0].most)[1]) if size else (0, 0)

    def pack(batches):
        for b in batches:
            ok, n, flat, begin = usable(b)
            at = np.flatnonzero(ok & (n == width))
            if len(at):
                x = flat[(begin[at][:, None] + np.arange(width)).reshape(-1)] + 0.0  # no -0.0: equal vectors have equal bytes
                ends = np.arange(1, len(at) + 1)
                exact = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends * width]).astype(np.int32)), pa.array(x))
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at)), exact, _cut(np.ldexp(x, shift).astype("<f4").tobytes(), ends, 4 * width)],
                                                 names=["id", "exact", "v"])

    base = cut_lineage(rows.mapInArrow(pack, "id long, exact array<double>, v binary"))
    if not _repeated(base, F.col("id")):
        return base
    return base.groupBy("id").agg(F.min(F.struct("exact", "v")).alias("x")).select("id", "x.exact", "x.v")


def _repeated(rows: DataFrame, key) -> bool:
    """Whether some value of ``key`` is in more than one row."""
    return bool(rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect())


def _matrix(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f4").reshape(len(column), -1)


def forest_of(vectors: DataFrame, n: int, trees: int, leaf: int, seed: int = SEED) -> list:
    """For each tree (directions, thresholds by level): a vector goes right where its product with the level's direction is above
    the threshold of the node that it has come to, the median of a hashed sample there."""
    bits = max(0, math.ceil(math.log2(max(1, n) / leaf))) if n > leaf else 0
    if not bits:
        return [(None, [])] * trees
    order = vectors.select("v").orderBy(F.xxhash64("id", F.lit(seed)))
    width = max(1, len(order.limit(1).collect()[0].v))
    x = np.stack([np.frombuffer(bytes(r.v), "<f4") for r in order.limit(max(256, min(FOREST, 4 * 1024 * FOREST // 16 // width))).collect()])
    out = []
    for t in range(trees):
        rng = np.random.default_rng([seed, t])
        pair = rng.integers(0, len(x), (2, bits))
        planes = x[pair[0]] - x[pair[1]]
        size = np.sqrt((planes.astype(np.float64) ** 2).sum(axis=1))
        other = rng.standard_normal(planes.shape).astype(np.float32)
        planes = np.where(size[:, None] > 0, planes / np.where(size > 0, size, 1)[:, None], other).astype(np.float32)
        side, node, cuts = x @ planes.T, np.zeros(len(x), np.int64), []
        for b in range(bits):
            o = np.lexsort((side[:, b], node))
            s = _starts(node[o])
            n_of = np.diff(np.append(s, len(o)))
            cut = np.zeros(1 << b, np.float32)
            cut[node[o][s]] = side[o[s + (n_of - 1) // 2], b]
            cuts.append(cut)
            node = node * 2 + (side[:, b] > cut[node])
        out.append((planes, cuts))
    return out


def _leaf_of(x: np.ndarray, tree: tuple) -> np.ndarray:
    planes, cuts = tree
    node = np.zeros(len(x), np.int64)
    if cuts:
        side = x @ planes.T
        for b, cut in enumerate(cuts):
            node = node * 2 + (side[:, b] > cut[node])
    return node


def leaf_codes(vectors: DataFrame, n: int, trees: int, leaf: int, seed: int = SEED, forest: list | None = None) -> DataFrame:
    """(id, tree, code): the leaf of each tree in which a vector lies."""
    forest = forest or forest_of(vectors, n, trees, leaf, seed)

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v")) if b.num_rows else np.empty((0, 1), np.float32)
            for t, tree in enumerate(forest if b.num_rows else ()):
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.full(len(x), t, np.int32)), pa.array(_leaf_of(x, tree))],
                                                 names=["id", "tree", "code"])

    return vectors.select("id", "v").mapInArrow(run, "id long, tree int, code long")


# A walk: the nodes of its beam by distance, ``old`` marks those that were expanded, ``open`` counts the others, ``worst`` is
# the distance a newcomer must beat, ``beam`` how many nodes it keeps.
LISTS = "id long, beam int, v binary, at binary, d binary, old binary, open int, worst float"
NAMES = [x.split()[0] for x in LISTS.split(", ")]


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal keys begins."""
    change = np.ones(len(sorted_keys[0]), dtype=bool)
    if len(change):
        change[1:] = False
        for k in sorted_keys:
            change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted values, each once (by sorting: ``np.unique`` hashes, which takes many times as long here)."""
    x = np.sort(x)
    return x[_starts(x)]


def _cut(raw: bytes, ends: np.ndarray, width: int) -> pa.Array:
    """Slices of ``raw`` that end at ``ends`` (in items of ``width`` bytes), as a binary column."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _ranked(ids, at, d, old):
    """Entries by id, distance and partner, and the rank of each with its id; a repeated partner counts once."""
    if not len(ids):
        return ids, at, d, old, np.zeros(0, np.int64)
    low = int(at.min())
    span = int(at.max()) - low + 1
    own = _distinct(ids)
    row = np.searchsorted(own, ids)
    o = np.argsort(row * span + (at - low)) if len(own) * span < 2**62 else np.lexsort((at, row))
    row, at, d, old = row[o], at[o], d[o], old[o]
    s = _starts(row, at)
    if len(s) < len(row):
        row, at, d, old = row[s], at[s], np.minimum.reduceat(d, s), np.maximum.reduceat(old, s)
    d = d.astype(np.float32) + np.float32(0)
    o = np.argsort(row << 32 | d.view(np.uint32).astype(np.int64), kind="stable")  # distances are not negative: their bits sort as they do
    row, at, d, old = row[o], at[o], d[o], old[o]
    s = _starts(row)
    return own[row], at, d, old, np.arange(len(row)) - np.repeat(s, np.diff(np.append(s, len(row))))


def _best(ids, at, d, old, most):
    """The ``most`` nearest partners of each id, sorted by id, distance and partner; a repeated partner counts once."""
    ids, at, d, old, rank = _ranked(ids, at, d, old)
    keep = rank < most
    return ids[keep], at[keep], d[keep], old[keep]


def _rows(owners, beam, n, at, d, old, vectors=None) -> pa.RecordBatch:
    """Rows of ``LISTS``: of the nodes, in order, ``n[i]`` belong to ``owners[i]``."""
    ends = np.cumsum(n)
    total = np.concatenate([[0], np.cumsum(old == 0)])
    worst = np.where(n >= beam, d[np.maximum(ends - 1, 0)] if len(d) else np.inf, np.inf).astype(np.float32)
    return pa.RecordBatch.from_arrays(
        [pa.array(owners), pa.array(beam.astype(np.int32)), pa.array(vectors if vectors is not None else [None] * len(owners), pa.binary()),
         _cut(at.tobytes(), ends, 8), _cut(d.astype("<f4").tobytes(), ends, 4), _cut(old.astype(np.uint8).tobytes(), ends, 1),
         pa.array((total[ends] - total[ends - n]).astype(np.int32)), pa.array(worst)], names=NAMES)


def _unpack(b):
    """(row numbers, at, d, old): one entry for each node in a batch of ``LISTS`` rows."""
    n = np.array([len(x) for x in b.column("old").to_pylist()], np.int64)
    return (np.repeat(np.arange(b.num_rows), n), np.frombuffer(b"".join(b.column("at").to_pylist()), "<i8"),
            np.frombuffer(b"".join(b.column("d").to_pylist()), "<f4"), np.frombuffer(b"".join(b.column("old").to_pylist()), np.uint8))


def _merged(lists: DataFrame, parts: int) -> DataFrame:
    """One row of ``LISTS`` per id: the nearest nodes, as many as its beam holds. A task holds a batch and one id's row."""
    def run(batches):
        held = None  # the row of the last id, which the next batch may go on with
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.concat_batches([held, pa.RecordBatch.from_arrays(b.columns, names=NAMES)])
            row, at, d, old = _unpack(b)
            own, v = b.column("id").to_numpy(), b.column("v").to_pylist()
            vectors = {i: x for i, x in zip(own.tolist(), v) if x is not None}
            s = _starts(own)
            owners, beam = own[s], b.column("beam").to_numpy()[s]
            ids, at, d, old, rank = _ranked(own[row], at, d, old)
            keep = rank < beam[np.searchsorted(owners, ids)]
            ids, at, d, old = ids[keep], at[keep], d[keep], old[keep]
            n = np.searchsorted(ids, owners, "right") - np.searchsorted(ids, owners, "left")
            out = _rows(owners, beam, n, at, d, old, [vectors.get(i) for i in owners.tolist()])
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            held = out.slice(out.num_rows - 1)
        if held is not None:
            yield held

    return (lists.repartitionById(parts, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).sortWithinPartitions("id")
            .mapInArrow(run, LISTS))


# What moves between tasks: arrays of items for one block, each kind with columns of its own. ``open`` counts new edges.
PARCEL = "block int, kind int, open long, a binary, b binary, c binary, e binary"
VECTOR, LIST, POINTER, GROUP, PROPOSAL, LINKS, ASKED, CANDIDATE, WALK = range(9)
#: Types and widths of the columns (-1: the rest).
KINDS = {VECTOR: (("<i8", 0), ("<f4", -1), ("<f4", 0)), LIST: (("<i8", 0), ("<i8", -1), ("<f4", -1), ("u1", -1)),
         POINTER: (("<i8", 0), ("<i8", 0), ("u1", 0)), GROUP: (("<i8", 0), ("<i8", -1), ("u1", -1)),
         PROPOSAL: (("<i8", 0), ("<i8", 0), ("<f4", 0)), LINKS: (("<i8", 0), ("<i4", 0), ("<i8", 0)), ASKED: (("<i8", 0), ("<i8", 0)),
         CANDIDATE: (("<i8", 0), ("<i8", 0)), WALK: (("<i8", 0), ("<f4", -1), ("<f4", 0), ("<i4", 0))}


class Blocks:
    """Equal ranges of ids; ids are numbers without large gaps."""

    def __init__(self, vectors: DataFrame):
        r = vectors.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.max(F.length("v"))).first()
        self.n, self.low, width = r[0], r[1] or 0, r[3] or 4
        spark = vectors.sparkSession
        cores = max(spark.sparkContext.defaultParallelism, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64))
        self.count = max(1, -(-self.n * width // BLOCK), min(cores, -(-self.n // LEAST)))
        self.size = max(1, -(-((r[2] or 0) - self.low + 1) // self.count))

    def of(self, ids: np.ndarray) -> np.ndarray:
        return np.clip((ids - self.low) // self.size, 0, self.count - 1)


def _sent(kind: int, block: np.ndarray, *columns: np.ndarray, fresh: np.ndarray | None = None) -> pa.RecordBatch:
    """Parcels of the items (rows of the columns) for their blocks; ``fresh``: new edges of each item."""
    few = len(block) and int(block.max()) < 32768  # sorted by digits then
    o = np.argsort(block.astype(np.int16) if few else block, kind="stable")
    block = block[o]
    s = _starts(block)
    pieces = [i for i, j in zip(s.tolist(), [*s[1:].tolist(), len(block)]) for i in range(i, j, ITEMS)]
    ends = np.array([*pieces[1:], len(block)][:len(pieces)], np.int64)
    arrays = [pa.array(block[pieces].astype(np.int32)), pa.array(np.full(len(pieces), kind, np.int32)),
              pa.array(np.add.reduceat(fresh[o], pieces).astype(np.int64) if fresh is not None and len(pieces) else np.zeros(len(pieces), np.int64))]
    for (dtype, _), x in zip(KINDS[kind], columns):
        x = np.ascontiguousarray(x[o], dtype)
        arrays.append(_cut(memoryview(x).cast("B"), ends, x.itemsize * (x.shape[1] if x.ndim > 1 else 1)))
    arrays += [pa.nulls(len(pieces), pa.binary())] * (7 - len(arrays))
    return pa.RecordBatch.from_arrays(arrays, names=["block", "kind", "open", "a", "b", "c", "e"])


def _arrived(rows: list, kind: int) -> list:
    """The columns of all items of a kind in ``rows``, lists of (kind, a, b, c, e)."""
    rows, out = [r for r in rows if r[0] == kind], []
    for c, (dtype, width) in enumerate(KINDS[kind], 1):
        x = np.frombuffer(b"".join([r[c].as_buffer() for r in rows if r[c].is_valid]), dtype)
        out.append(x.reshape(len(out[0]) if len(out[0]) else 0, -1) if width and len(x) else x.reshape(-1, 1) if width else x)
    return out


def _received(batches) -> list:
    """(kind, a, b, c, e) of all parcels of a task."""
    return [(k, *cols) for b in batches for k, *cols in zip(b.column("kind").to_pylist(), *(b.column(x) for x in "abce"))]


def _at_blocks(parcels: DataFrame, blocks: Blocks, run) -> DataFrame:
    """``run`` on all parcels of each block, one task a block."""
    return parcels.repartitionById(blocks.count, "block").mapInArrow(run, PARCEL)


def _packed(vectors: DataFrame, blocks: Blocks) -> DataFrame:
    """The vectors as parcels, one file a block."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                ids = b.column("id").to_numpy()
                yield _sent(VECTOR, blocks.of(ids), ids, _matrix(b.column("v")))

    return cut_lineage(vectors.select("id", "v").mapInArrow(run, PARCEL).repartitionById(blocks.count, "block"))


def _distances(x: np.ndarray, rows: slice = slice(None)) -> np.ndarray:
    sq = np.einsum("ij,ij->i", x, x)
    d = x[rows] @ x.T
    d *= -2
    d += sq[rows, None]
    d += sq
    np.maximum(d, 0, out=d)
    d[np.arange(len(d)), np.arange(len(x))[rows]] = np.inf
    return d


def _nearest_of(d: np.ndarray, k: int):
    """(positions, distances) of the ``k`` least of each row. A first part of the columns bounds what the others can add."""
    m = d.shape[1]
    first = max(4 * k, m // 4)
    if m <= 2 * first:
        at = np.argpartition(d, k - 1, axis=1)[:, :k]
        return at, np.take_along_axis(d, at, 1)
    bound = np.partition(d[:, :first], k - 1, axis=1)[:, k - 1]
    flat = np.flatnonzero(d <= bound[:, None])
    value, row = d.reshape(-1)[flat], flat // m
    col = flat - row * m
    o = np.argsort(row << 32 | value.view(np.uint32).astype(np.int64))
    s = _starts(row)  # each row has k at least
    o = o[(s[:, None] + np.arange(k)).reshape(-1)]
    return col[o].reshape(-1, k), value[o].reshape(-1, k)


def _leaf_lists(packed: DataFrame, blocks: Blocks, forest: list, degree: int) -> DataFrame:
    """Parcels of lists: the nearest of each vector within each of its leaves."""
    leaves = 1 << len(forest[0][1])

    def deal(batches):
        for b in batches:
            if b.num_rows:
                ids, x, _ = _arrived(_received([b]), VECTOR)
                for t, tree in enumerate(forest):
                    yield _sent(VECTOR, t * leaves + _leaf_of(x, tree), ids, x)

    def compared(rows):
        ids, x, _ = _arrived(rows, VECTOR)
        k = min(degree, len(ids) - 1)
        if k < 1:
            return
        at, d = np.full((len(ids), degree), -1, np.int64), np.full((len(ids), degree), np.inf, np.float32)
        for a in range(0, len(ids), 512):
            near, d[a:a + 512, :k] = _nearest_of(_distances(x, slice(a, a + 512)), k)
            at[a:a + 512, :k] = ids[near]
        yield _sent(LIST, blocks.of(ids), ids, at, d, np.zeros(at.shape, np.uint8))

    def near(batches):
        held, now, n = [], None, 0
        for b in batches:
            for leaf, *row in zip(b.column("block").to_pylist(), *_received_columns(b)):
                if held and (leaf != now or n >= LEAF_MOST):
                    yield from compared(held)
                    held, n = [], 0
                now = leaf
                held.append(row)
                n += len(row[1].as_buffer()) // 8
        if held:
            yield from compared(held)

    parts = min(len(forest) * leaves, 4 * blocks.count)
    dealt = packed.mapInArrow(deal, PARCEL).repartitionById(parts, F.pmod("block", F.lit(parts)))
    return dealt.sortWithinPartitions("block", F.xxhash64("a", "block")).mapInArrow(near, PARCEL)


def _received_columns(b):
    return b.column("kind").to_pylist(), *(b.column(x) for x in "abce")


def _listed(blocks: Blocks, degree: int):
    """A block's lists: of those that arrive for a node, and proposals, the ``degree`` nearest stay."""
    def run(batches):
        rows = _received(batches)
        nodes = np.sort(_arrived(rows, VECTOR)[0])
        ids, at, d, old = _arrived(rows, LIST)
        to, one, far = _arrived(rows, PROPOSAL)
        own = _distinct(np.concatenate([nodes, ids]))
        del rows
        for a in range(0, len(own), ITEMS):  # bounded sorts
            low, high = own[a], own[min(a + ITEMS, len(own)) - 1]
            i, j = (ids >= low) & (ids <= high), (to >= low) & (to <= high)
            flat, owner = at[i].reshape(-1), np.repeat(ids[i], at.shape[1])
            is_one = flat >= 0
            new = np.zeros(int(j.sum()), np.uint8)
            i, p, f, o, rank = _ranked(np.concatenate([owner[is_one], to[j]]), np.concatenate([flat[is_one], one[j]]),
                                       np.concatenate([d[i].reshape(-1)[is_one], far[j]]), np.concatenate([old[i].reshape(-1)[is_one], new]))
            keep = rank < degree
            part = own[a:a + ITEMS]
            row, rank = np.searchsorted(part, i[keep]), rank[keep]
            shape = (len(part), degree)
            at_, d_, old_ = np.full(shape, -1, np.int64), np.full(shape, np.inf, np.float32), np.ones(shape, np.uint8)
            at_[row, rank], d_[row, rank], old_[row, rank] = p[keep], f[keep], o[keep]
            yield _sent(LIST, blocks.of(part), part, at_, d_, old_, fresh=(old_ == 0).sum(axis=1))

    return run


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """32 hashed bits of each id."""
    h = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 2)) & (2**64 - 1))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(32)).astype(np.int64)


def _sampled(row: np.ndarray, who: np.ndarray, most: int, salt: int):
    """(which, rank): at most ``most`` entries of each row, by hashes of ``who``."""
    o = np.argsort(row << 32 | _mixed(who * 1_000_003 + row, salt), kind="stable")
    s = _starts(row[o])
    rank = np.arange(len(o)) - np.repeat(s, np.diff(np.append(s, len(o))))
    keep = rank < most
    return o[keep], rank[keep]


def _proposals(graph: DataFrame, packed: DataFrame, blocks: Blocks, degree: int, salt: int) -> DataFrame:
    """Parcels of proposals: for each vector the nearer ones met in the joins of its neighbours and of those it is near to."""
    def point(batches):
        for b in batches:
            if b.num_rows:
                yield b
                ids, at, _, old = _arrived(_received([b]), LIST)
                is_one = at.reshape(-1) >= 0
                at, owner, fresh = at.reshape(-1)[is_one], np.repeat(ids, at.shape[1])[is_one], (old.reshape(-1) == 0)[is_one]
                yield _sent(POINTER, blocks.of(at), at, owner, fresh)

    def gather(batches):
        rows = _received(batches)
        ids, x, _ = _arrived(rows, VECTOR)
        if not len(ids):
            return
        o = np.argsort(ids)
        ids, x = ids[o], x[o]
        own, at, d, old = _arrived(rows, LIST)
        o = np.argsort(own)
        at, worst, old = at[o], d[o, -1], old[o]
        to, who, fresh = _arrived(rows, POINTER)
        del rows
        row = np.searchsorted(ids, to)
        which, rank = _sampled(row, who, REVERSE, salt)
        members = np.full((len(ids), degree + REVERSE), -1, np.int64)
        news = np.zeros(members.shape, np.uint8)
        members[:, :degree], news[:, :degree] = at, (at >= 0) & (old == 0)
        members[row[which], degree + rank], news[row[which], degree + rank] = who[which], fresh[which]
        some = news.any(axis=1)
        if some.any():
            yield _sent(GROUP, blocks.of(ids[some]), ids[some], members[some], news[some])
        # a vector goes to each block with a vector near it or one that it is near to
        is_one = at.reshape(-1) >= 0
        keys = _distinct(np.concatenate([np.repeat(np.arange(len(ids)), degree)[is_one] * blocks.count + blocks.of(at.reshape(-1)[is_one]),
                                         row * blocks.count + blocks.of(who), np.arange(len(ids)) * blocks.count + blocks.of(ids)]))
        for a in range(0, len(keys), 4 * ITEMS):
            row, to = np.divmod(keys[a:a + 4 * ITEMS], blocks.count)
            yield _sent(VECTOR, to, ids[row], x[row], worst[row])

    def near(batches):
        rows = _received(batches)
        u, members, fresh = _arrived(rows, GROUP)
        ids, x, worst = _arrived(rows, VECTOR)
        del rows
        if not len(u):
            return
        o = np.argsort(ids, kind="stable")
        o = o[_starts(ids[o])]
        ids = ids[o]
        held, n = [], 0
        for a in range(0, len(u), 512):
            m = np.concatenate([members[a:a + 512], u[a:a + 512, None]], axis=1)
            new = np.concatenate([fresh[a:a + 512] > 0, np.zeros((len(m), 1), bool)], axis=1)
            i = o[np.minimum(np.searchsorted(ids, m), len(ids) - 1)]
            limit = np.where(m >= 0, worst[i], -1)
            y = x[i]
            sq = np.einsum("gid,gid->gi", y, y)
            d = np.matmul(y, y.transpose(0, 2, 1))
            d *= -2
            d += sq[:, :, None]
            d += sq[:, None, :]
            np.maximum(d, 0, out=d)
            g, i, j = np.nonzero(d < limit[:, :, None])
            p, q = m[g, i], m[g, j]
            keep = (q >= 0) & (p != q) & (new[g, i] | new[g, j])
            held.append((p[keep], q[keep], d[g[keep], i[keep], j[keep]]))
            n += len(held[-1][0])
            if n >= BUFFER or a + 512 >= len(u):
                p, q, d = (np.concatenate(c) for c in zip(*held))
                p, q, d, _ = _best(p, q, d, np.zeros(len(p), np.uint8), degree)
                if len(p):
                    yield _sent(PROPOSAL, blocks.of(p), p, q, d)
                held, n = [], 0

    pointed = graph.mapInArrow(point, PARCEL).unionByName(packed)
    return _at_blocks(_at_blocks(pointed, blocks, gather), blocks, near)


def _all_old(graph: DataFrame) -> DataFrame:
    """The same lists with every partner marked."""
    return graph.withColumn("e", F.unhex(F.expr("repeat('01', length(e))"))).withColumn("open", F.lit(0).cast("long"))


def _edges(graph: DataFrame) -> DataFrame:
    """(id, nbr, d) from parcels of lists."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                ids, at, d, _ = _arrived(_received([b]), LIST)
                is_one = at.reshape(-1) >= 0
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, at.shape[1])[is_one]), pa.array(at.reshape(-1)[is_one]),
                                                  pa.array(d.reshape(-1)[is_one])], names=["id", "nbr", "d"])

    return graph.mapInArrow(run, "id long, nbr long, d float")


def build_graph(vectors: DataFrame, forest: list, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """NN-descent: rows (id, nbr, d), ``degree`` per vector, ``d`` squared distance in single precision."""
    log = logging.getLogger(__name__)
    blocks = Blocks(vectors)
    packed = _packed(vectors, blocks)
    none = F.lit(None).cast("binary")
    nodes = packed.withColumn("b", none).withColumn("c", none)
    graph = cut_lineage(_at_blocks(nodes.unionByName(_leaf_lists(packed, blocks, forest, degree)), blocks, _listed(blocks, degree)))
    for step in range(rounds):
        before = graph
        graph = cut_lineage(_at_blocks(_all_old(before).unionByName(_proposals(before, packed, blocks, degree, step)), blocks,
                                       _listed(blocks, degree)))
        release(before)
        changed = graph.agg(F.sum("open")).first()[0] or 0
        log.info("NN-descent round %d: %d of %d edges are new", step, changed, blocks.n * degree)
        if changed <= SETTLED * blocks.n * degree:
            break
    else:
        log.warning("NN-descent: %d rounds did not settle the graph of %d vectors", rounds, blocks.n)
    release(packed)
    return _edges(graph)


def reach_of(sample: list, vectors: DataFrame, k: int) -> list:
    """(qid, reach, k) for each of the ``sample`` rows (qid, qv): the squared distance, in double precision, of the k-th nearest
    other vector by comparison with all of them, and how many there are up to k. Each task keeps ``k`` distances a sampled query."""
    ids = [r.qid for r in sample]
    q = np.stack([np.frombuffer(bytes(r.qv), "<f4") for r in sample]).astype(np.float64)
    slack = 1e-12 * q.shape[1]  # more than the products below are wrong by, as no component is above 1

    def run(batches):
        best = [np.empty(0)] * len(ids)
        for b in batches:
            if not b.num_rows:
                continue
            x, node = _matrix(b.column("v")).astype(np.float64), b.column("id").to_numpy()
            rough = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * (q @ x.T)
            for s, one in enumerate(ids):
                at = np.flatnonzero(node != one) if len(node) <= k + 1 else np.flatnonzero(
                    (rough[s] <= min(np.partition(rough[s], k)[k], best[s].max() if len(best[s]) == k else np.inf) + slack) & (node != one))
                d = np.concatenate([best[s], ((x[at] - q[s]) ** 2).sum(axis=1)])
                best[s] = np.partition(d, k - 1)[:k] if len(d) > k else d
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), [len(d) for d in best])),
                                          pa.array(np.concatenate(best))], names=["qid", "d"])

    w = Window.partitionBy("qid").orderBy("d")
    near = vectors.select("id", "v").mapInArrow(run, "qid long, d double")
    return (near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
            .groupBy("qid").agg(F.max("d").alias("reach"), F.count(F.lit(1)).alias("k")).collect())


def _links(graph: DataFrame, blocks: Blocks) -> DataFrame:
    """Parcels of the nodes that a walk goes on to from each node: its neighbours and a sample of those that point at it."""
    def edges(batches):
        held, n = [], 0
        for b in batches:
            held.append((b.column("id").to_numpy(), b.column("nbr").to_numpy()))
            n += b.num_rows
            if n >= BUFFER // 4:
                yield from routed(held)
                held, n = [], 0
        if n:
            yield from routed(held)

    def routed(held):
        ids, at = (np.concatenate(c) for c in zip(*held))
        yield _sent(PROPOSAL, blocks.of(ids), ids, at, np.zeros(len(ids), np.float32))
        yield _sent(POINTER, blocks.of(at), at, ids, np.zeros(len(ids), np.uint8))

    def linked(batches):
        rows = _received(batches)
        ids, at, _ = _arrived(rows, PROPOSAL)
        to, who, _ = _arrived(rows, POINTER)
        del rows
        both = np.concatenate([ids, to])
        own = _distinct(both)
        row = np.searchsorted(own, both)
        which, _ = _sampled(row[len(ids):], who, REVERSE, -1)
        row = np.concatenate([row[:len(ids)], row[len(ids):][which]])
        _, at, _, _, rank = _ranked(row, np.concatenate([at, who[which]]), np.zeros(len(row), np.float32), np.zeros(len(row), np.uint8))
        first = np.append(np.flatnonzero(rank == 0), len(at))
        for a in range(0, len(own), ITEMS):
            z = min(a + ITEMS, len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(blocks.of(own[a:a + 1])[0])], pa.int32()), pa.array([LINKS], pa.int32()), pa.array([0], pa.int64()),
                 pa.array([own[a:z].astype("<i8").tobytes()], pa.binary()), pa.array([np.diff(first[a:z + 1]).astype("<i4").tobytes()], pa.binary()),
                 pa.array([at[first[a]:first[z]].astype("<i8").tobytes()], pa.binary()), pa.nulls(1, pa.binary())],
                names=["block", "kind", "open", "a", "b", "c", "e"])

    return cut_lineage(_at_blocks(graph.select("id", "nbr").mapInArrow(edges, PARCEL), blocks, linked))


def _pairs(rows: DataFrame, blocks: Blocks) -> DataFrame:
    """Parcels of candidates from rows (id, node)."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                node = b.column("node").to_numpy()
                yield _sent(CANDIDATE, blocks.of(node), node, b.column("id").to_numpy())

    return rows.select("id", "node").mapInArrow(run, PARCEL)


def _walkers(walks: DataFrame, blocks: Blocks, every: bool = False) -> DataFrame:
    """Parcels of the walks' vectors, worst distances and beams for all blocks; of walks that go on, if not ``every``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                ids, x, n = b.column("id").to_numpy(), _matrix(b.column("v")), b.num_rows
                for block in range(blocks.count):
                    yield _sent(WALK, np.full(n, block), ids, x, b.column("worst").to_numpy(), b.column("beam").to_numpy())

    return (walks if every else walks.where("open > 0")).select("id", "beam", "v", "worst").mapInArrow(run, PARCEL)


def _measured(batches, exact: bool):
    """(walk ids, nodes, squared distances, worst distances, beams) of the candidates of a block, by walk; in double precision if ``exact``."""
    rows = _received(batches)
    ids, x, _ = _arrived(rows, VECTOR)
    node, walk = _arrived(rows, CANDIDATE)
    own, q, worst, beam = _arrived(rows, WALK)
    del rows
    if not len(node):
        return
    o, w = np.argsort(ids), np.argsort(own)
    ids, x, own, q, worst, beam = ids[o], x[o], own[w], q[w], worst[w], beam[w]
    gapless = ids[-1] - ids[0] + 1 == len(ids)
    i, j = node - ids[0] if gapless else np.searchsorted(ids, node), np.searchsorted(own, walk)
    key = _distinct(j * len(ids) + i)  # several nodes of a beam lead to the same one
    j, i = np.divmod(key, len(ids))
    d = np.empty(len(j), np.float64 if exact else np.float32)
    for a in range(0, len(j), ITEMS // 4):  # few enough to stay in the processor's cache
        off = np.take(x, i[a:a + ITEMS // 4], axis=0).astype(d.dtype, copy=False)
        off -= np.take(q, j[a:a + ITEMS // 4], axis=0)
        d[a:a + ITEMS // 4] = (off ** 2).sum(axis=1) if exact else np.einsum("ij,ij->i", off, off)
    yield own[j], ids[i], d, worst[j], beam[j]


def recall_of(walks: DataFrame, reach: dict, vectors: DataFrame, blocks: Blocks) -> dict:
    """How many of the true neighbours are in the beam of each walk in ``reach`` (walk id: query, reach; at equal distance any node
    counts), measured in double precision. ``vectors``: parcels."""
    def beams(batches):
        for b in batches:
            if b.num_rows:
                row, at, _, _ = _unpack(b)
                yield pa.RecordBatch.from_arrays([pa.array(b.column("id").to_numpy()[row]), pa.array(at)], names=["id", "node"])

    def hits(batches):
        for walk, node, d, _, _ in _measured(batches, True):
            asked = np.array([reach[i] for i in walk.tolist()], "i8,f8")
            near = (node != asked["f0"]) & (d <= asked["f1"] * (1 + 1e-12))
            yield pa.RecordBatch.from_arrays([pa.array(walk[near])], names=["id"])

    tried = walks.where(F.col("id").isin(list(reach)))
    cand = _pairs(tried.mapInArrow(beams, "id long, node long"), blocks)
    met = cand.unionByName(vectors).unionByName(_walkers(tried, blocks, every=True)).repartitionById(blocks.count, "block").mapInArrow(hits, "id long")
    return {r.id: r.n for r in met.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()}


def search(queries: DataFrame, vectors: DataFrame, codes: DataFrame, query_codes: DataFrame, graph: DataFrame, k: int,
           beam: int = BEAM, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(qid, node, d): the best nodes each query's walk has met, those of its beam that can be among the ``k`` nearest and the
    query itself when they are measured in double precision. ``queries``: (qid, qv), rows of ``vectors`` (a walk also
    enters at its own node). The beam grows until the ``sample`` queries find ``target`` of their ``k`` nearest."""
    log = logging.getLogger(__name__)
    blocks = Blocks(vectors)
    packed, links = _packed(vectors, blocks), _links(graph, blocks)

    def picks(b, row: np.ndarray, old: np.ndarray) -> np.ndarray:
        """Which entries a hop expands: the nearest unexpanded ones of each walk, an ``EXPAND``-th of its beam."""
        fresh = old == 0
        before = np.cumsum(fresh) - fresh
        s = _starts(row)
        return fresh & (before - np.repeat(before[s], np.diff(np.append(s, len(row)))) < np.maximum(1, b.column("beam").to_numpy() // EXPAND)[row])

    def asked(batches):
        for b in batches:
            if b.num_rows:
                row, at, _, old = _unpack(b)
                p = picks(b, row, old)
                yield _sent(ASKED, blocks.of(at[p]), at[p], b.column("id").to_numpy()[row[p]])

    def marked(batches):
        for b in batches:
            if b.num_rows:
                row, at, d, old = _unpack(b)
                yield _rows(b.column("id").to_numpy(), b.column("beam").to_numpy(), np.bincount(row, minlength=b.num_rows), at, d,
                            old | picks(b, row, old), b.column("v").to_pylist())

    def expanded(batches):
        rows = _received(batches)
        node, walk = _arrived(rows, ASKED)
        ids, n, to = _arrived(rows, LINKS)
        del rows
        if not len(node) or not len(ids):
            return
        first = np.cumsum(n, dtype=np.int64) - n
        o = np.argsort(ids)
        i = np.minimum(np.searchsorted(ids, node, sorter=o), len(ids) - 1)
        i = o[i]
        has = ids[i] == node
        i, walk = i[has], walk[has]
        for a in range(0, len(i), 16 * ITEMS):
            f, m = first[i[a:a + 16 * ITEMS]], n[i[a:a + 16 * ITEMS]].astype(np.int64)
            at = to[np.repeat(f - (np.cumsum(m) - m), m) + np.arange(m.sum())]
            yield _sent(CANDIDATE, blocks.of(at), at, np.repeat(walk[a:a + 16 * ITEMS], m))

    def found(batches):
        for walk, node, d, worst, most in _measured(batches, False):
            keep = d < worst
            beam_of = most[_starts(walk)]
            walk_of = walk[_starts(walk)]
            ids, at, d, old, rank = _ranked(walk[keep], node[keep], d[keep], np.zeros(int(keep.sum()), np.uint8))
            keep = rank < beam_of[np.searchsorted(walk_of, ids)]
            ids, at, d, old = ids[keep], at[keep], d[keep], old[keep]
            s = _starts(ids)
            if len(s):
                yield _rows(ids[s], beam_of[np.searchsorted(walk_of, ids[s])], np.diff(np.append(s, len(ids))), at, d, old)

    def met(walks: DataFrame, cand: DataFrame, every: bool = False) -> DataFrame:
        """Rows of ``LISTS`` from candidates: the nodes that are nearer than the walk's worst."""
        here = cand.unionByName(packed).unionByName(_walkers(walks, blocks, every))
        return here.repartitionById(blocks.count, "block").mapInArrow(found, LISTS)

    def walked(starts: DataFrame, entries: DataFrame, n: int) -> DataFrame:
        """The ends of the walks from rows (id, v, beam), which enter at (id, node)."""
        parts = max(1, min(4 * blocks.count, -(-n // 64)))
        none = F.lit(b"")
        begun = starts.select("id", F.col("beam").cast("int").alias("beam"), "v", none.alias("at"), none.alias("d"), none.alias("old"),
                              F.lit(0).alias("open"), F.lit(float("inf")).cast("float").alias("worst"))
        walks = cut_lineage(_merged(begun.unionByName(met(begun, _pairs(entries, blocks), every=True)), parts))
        hops = 0
        while walks.agg(F.sum("open")).first()[0]:  # ends: what a beam has dropped does not come back
            cand = _at_blocks(walks.where("open > 0").mapInArrow(asked, PARCEL).unionByName(links), blocks, expanded)
            before = walks
            walks = cut_lineage(_merged(before.mapInArrow(marked, LISTS).unionByName(met(before, cand)), parts))
            release(before)
            hops += 1
        log.info("%d walks took %d hops", n, hops)
        return walks

    def nearest_of(walks: DataFrame) -> DataFrame:
        """(id, node, d): of each beam what rounding to single precision leaves a chance to be among the k nearest besides the query."""
        def run(batches):
            for b in batches:
                if b.num_rows:
                    row, at, d, _ = _unpack(b)
                    width = len(b.column("v")[0].as_buffer()) // 4
                    s = _starts(row)
                    n = np.diff(np.append(s, len(row)))
                    far = np.sqrt(d.astype(np.float64))
                    far_k = np.repeat(far[s + np.minimum(n - 1, k)], n)
                    keep = far <= far_k * (1 + 2e-7 * (width + 8)) + 4e-7 * math.sqrt(width)
                    yield pa.RecordBatch.from_arrays([pa.array(b.column("id").to_numpy()[row[keep]]), pa.array(at[keep]), pa.array(d[keep])],
                                                     names=["id", "node", "d"])

        return walks.mapInArrow(run, "id long, node long, d float")

    hashed = [F.min(F.struct(F.xxhash64("id", "tree", F.lit(i)), F.col("id"))).getField("id") for i in range(ENTRIES)]
    doors = codes.groupBy("tree", "code").agg(F.array(*hashed).alias("node"))
    start = (query_codes.withColumnRenamed("id", "qid").join(doors, ["tree", "code"]).select("qid", F.explode("node").alias("node"))
             .unionAll(queries.select("qid", F.col("qid").alias("node")))).distinct()

    tried = queries.orderBy(F.xxhash64("qid", F.lit(SEED))).limit(sample).collect()
    if not tried:
        return start.select("qid", "node", F.lit(0).cast("float").alias("d")).where(F.lit(False))
    reach = {r.qid: r for r in reach_of(tried, vectors, k)}
    total = sum(r.k for r in reach.values())
    asks, n = queries.count(), blocks.n
    start = cut_lineage(start)
    tries = max(1, min(4, n >> 16))  # beams at once: a hop costs the passage of all vectors, whatever the number of walks
    share, chosen = 0.0, None
    while chosen is None:
        beams = [beam]
        while len(beams) < tries and beams[-1] < n:
            beams.append(beams[-1] + -(-beams[-1] // 2))
        rows = [(i * len(tried) + j, r.qid, one, bytearray(r.qv)) for i, one in enumerate(beams) for j, r in enumerate(tried)]
        runs = vectors.sparkSession.createDataFrame(rows, "id long, qid long, beam int, v binary")
        walks = walked(runs, start.join(runs.select("id", "qid"), "qid"), len(rows))
        hits = recall_of(walks, {i: (qid, reach[qid].reach) for i, qid, _, _ in rows if qid in reach}, packed, blocks) if total else {}
        for i, beam in enumerate(beams):
            share = sum(min(reach[r.qid].k, hits.get(i * len(tried) + j, 0)) for j, r in enumerate(tried) if r.qid in reach) / total if total else 1.0
            log.info("recall at %d: %.3f on %d queries against %d vectors, beam %d", k, share, len(tried), n, beam)
            if share >= target:
                chosen = i
                break
        else:
            if beam >= n:
                raise RuntimeError(f"the walks find {share:.3f} of the {k} nearest with a beam of all {n} vectors, {target} is required")
            beam += -(-beam // 2)
            tries = min(4, 2 * tries)
    low = chosen * len(tried)
    out = (nearest_of(walks.where(F.col("id").between(low, low + len(tried) - 1))).join(runs.select("id", "qid"), "id").select("qid", "node", "d"))
    if asks > len(tried):
        rest = queries.where(~F.col("qid").isin([r.qid for r in tried])).select(F.col("qid").alias("id"), F.lit(beam).alias("beam"), F.col("qv").alias("v"))
        entries = start.where(~F.col("qid").isin([r.qid for r in tried])).withColumnRenamed("qid", "id")
        out = out.unionAll(nearest_of(walked(rest, entries, asks - len(tried))).toDF("qid", "node", "d"))
    release(links)
    release(packed)
    return out


def _numbered(rows: DataFrame, tree: tuple) -> DataFrame:
    """``rows`` (id, v) with numbers ``node`` from 0, neighbours in the order of the tree's leaves."""
    def place(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_leaf_of(_matrix(b.column("v")), tree))], names=["id", "v", "leaf"])

    placed = rows.mapInArrow(place, "id long, v binary, leaf long") if tree[1] else rows.withColumn("leaf", F.lit(0))
    m = F.monotonically_increasing_id()
    sorted_ = cut_lineage(placed.repartitionByRange("leaf", "id").sortWithinPartitions("leaf", "id").select("id", "v", m.alias("m")))
    part = F.shiftright("m", 33)
    sizes = {r.p: r.n for r in sorted_.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, shift = 0, []
    for p in range(max(sizes, default=-1) + 1):
        shift.append(before - (p << 33))
        before += sizes.get(p, 0)
    to = F.element_at(F.array(*[F.lit(x).cast("long") for x in shift]), (part + 1).cast("int")) if shift else F.lit(0).cast("long")
    return sorted_.select((F.col("m") + to).alias("node"), "id", "v")


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", degree: int = DEGREE,
            rounds: int = ROUNDS, beam: int = BEAM) -> DataFrame:
    """For each row that ``is_query`` (a condition on ``id``): its ``k`` nearest other rows by Euclidean distance, as
    (query_id, rank, id_col, score)."""
    base = usable_vectors(df, id_col, vector)
    members = base.withColumn("r", F.lit(1)).withColumn("least", F.col("id"))
    if _repeated(base, F.xxhash64("v")):
        same = Window.partitionBy(F.xxhash64("v"), "exact")
        members = cut_lineage(base.withColumn("r", F.row_number().over(same.orderBy("id"))).withColumn("least", F.min("id").over(same)))
    leads = members.where("r = 1")
    n = leads.count()
    forest = forest_of(leads, n, TREES, LEAF)
    nodes = _numbered(leads.select("id", "v"), forest[0])
    vectors = nodes.select(F.col("node").alias("id"), "v")
    graph = build_graph(vectors, forest, degree, rounds)
    numbers = nodes.select("node", F.col("id").alias("least"))
    asked = cut_lineage(members.where(is_query).select(F.col("id").alias("query_id"), "least").join(numbers, "least")
                        .select("query_id", F.col("node").alias("qid")))
    chosen = cut_lineage(nodes.join(asked.select(F.col("qid").alias("node")), "node", "left_semi"))
    queries = chosen.select(F.col("node").alias("qid"), F.col("v").alias("qv"))
    codes = leaf_codes(vectors, n, TREES, LEAF, forest=forest)
    query_codes = leaf_codes(queries.toDF("id", "v"), n, TREES, LEAF, forest=forest)
    walked = search(queries, vectors, codes, query_codes, graph, k, beam)
    originals = leads.select(F.col("id").alias("least"), "exact")
    exact = (walked.join(numbers, "node").join(originals.withColumnRenamed("exact", "x"), "least")
             .join(chosen.select(F.col("node").alias("qid"), F.col("id").alias("least")).join(originals, "least").select("qid", F.col("exact").alias("q")), "qid")
             .withColumn("score", F.sqrt(F.expr("aggregate(zip_with(x, q, (a, b) -> (a - b) * (a - b)), 0D, (s, e) -> s + e)"))))

    def least(rows: DataFrame, key: str, node: str, most: int) -> DataFrame:
        w = Window.partitionBy(key).orderBy("score", node)
        return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)

    # one more than k, as the query itself is among them
    near = least(exact.select("qid", "least", "score"), "qid", "least", k + 1).drop("rank")
    near = least(near.join(members.where(F.col("r") <= k + 1).select("least", "id"), "least").select("qid", "id", "score"), "qid", "id", k + 1).drop("rank")
    found = asked.join(near, "qid").where(F.col("query_id") != F.col("id"))
    return least(found, "query_id", "id", k).select("query_id", "rank", F.col("id").alias(id_col), "score")
