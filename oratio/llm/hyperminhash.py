"""HyperMinHash near-duplicates on sets of word shingles.

A document's set is its distinct ``SHINGLE``-word shingles (A-Z lower-cased). Two documents are linked if
100 * intersection >= 80 * union of their sets; a component is what links connect.

Sketch: shingles are dealt over ``REGISTERS`` buckets by the top bits of a 64-bit hash; a register keeps the
number of leading zeros of the bucket's least remaining hash and the ``MANTISSA`` bits behind its first one, in
16 bits (0: empty bucket). Banding: for each of ``BANDS`` fixed bucket orders the first ``ROWS`` occupied registers
are one key, so sparsely filled sketches are banded as well as full ones; two sets of similarity 0.8 miss
all 48 keys with a probability of about 1e-11. Sets of fewer than ``SHORT_MOST`` shingles, whose few registers do
not allow that, are keyed by the least hashes of a prefix that similar sets must share (exact); sizes overlap so
that any linked pair has one of the two kinds in common. Candidates of a key are compared by register
matches less the matches expected by chance (the collision correction), dropped below 0.8 by more
than five standard deviations, and confirmed on the shingle sets of the whole texts.

Scale: equal sets collapse first (one row a set goes on, by partial aggregation). A key's first candidates
are its members against its least member, so a group of copies gives one pair a member and key, not all pairs.
Components of the confirmed links follow. Keys whose members are still in several components are compared
further, in cells of two blocks of about ``BLOCK`` members: their sketches name the members that may link to another component,
the whole sets of those alone come to the cell, and a cell returns links that join components, never all pairs.

Defined cases: a null, empty or wordless text has an empty set, links with nothing and is its own component;
fewer words than a shingle: the whole sequence is the one shingle; repeated rows share a set and
each keeps its row; a null id takes part and is ignored when the least id is chosen; empty tables give empty
results. Sets are told apart by a 64-bit hash of all their hashes; confirmation compares the shingles themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_name, release
from .components import connected_components

SHINGLE = 2
PERCENT = 80
REGISTERS = 256
MANTISSA = 10
BANDS = 48
ROWS = 4
SHORT_LEAST, SHORT_MOST = 64, 80  # below MOST: prefix keys; from LEAST on: register keys (80 * 0.8 = 64)
BLOCK = 1024
EARLIER = 256  # keys by which a cell tells the pairs that another cell compares
SLICE = 512
SIGMAS = 5.0


def shingle_set(text: str | None, shingle: int = SHINGLE) -> set[bytes]:
    """Distinct shingles of one text (bytes.lower() changes A-Z only, bytes.split() splits at the six blanks)."""
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    if len(w) < shingle:
        return {b" ".join(w)}
    return set(map(b" ".join, zip(*(w[i:] for i in range(shingle)))))


def set_hashes(shingles: set[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of a set."""
    import xxhash

    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), dtype=np.uint64, count=len(shingles)))


def registers(h: np.ndarray) -> np.ndarray:
    """Registers of a set given by its sorted hashes: (leading zeros + 1) and mantissa, 0 if empty."""
    out = np.zeros(REGISTERS, dtype=np.uint16)
    bits = REGISTERS.bit_length() - 1
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    first = np.ones(len(h), dtype=bool)
    first[1:] = bucket[1:] != bucket[:-1]
    rest = h[first] << np.uint64(bits)  # sorted: the least of each bucket
    zeros = np.zeros(len(rest), dtype=np.uint16)
    for step in (32, 16, 8, 4, 2, 1):
        low = rest < (np.uint64(1) << np.uint64(64 - step))
        rest = np.where(low, rest << np.uint64(step), rest)
        zeros += (low * step).astype(np.uint16)
    mantissa = (rest >> np.uint64(63 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out[bucket[first]] = (np.minimum(zeros, 62) + 1) << MANTISSA | mantissa.astype(np.uint16)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_orders() -> np.ndarray:
    """One fixed order of the buckets for each band, by a hash of (band, bucket)."""
    cell = np.arange(1, BANDS * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.argsort(_mix(cell).reshape(BANDS, REGISTERS), axis=1, kind="stable")


def band_keys(sketch: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: its first ``ROWS`` occupied registers with their buckets."""
    bands, pick = np.arange(len(orders)), np.zeros((len(orders), ROWS), dtype=np.int64)
    for width in (24, REGISTERS):  # most bands find their registers among their first buckets
        ahead = orders[bands, :width]
        used = sketch[ahead] > 0
        order = np.cumsum(used, axis=1)
        full = order[:, -1] >= ROWS
        chosen = (used & (order <= ROWS))[full]
        pick[bands[full]] = ahead[full][chosen].reshape(-1, ROWS)
        bands = bands[~full]
        if not len(bands):
            break
    key = np.arange(1, len(orders) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        b = pick[:, r]
        key = _mix(key ^ (b.astype(np.uint64) << np.uint64(16) | sketch[b].astype(np.uint64)))
    # a sketch with fewer occupied registers than a key needs has no register keys in the bands left
    return np.delete(key, bands)


def keys_of(h: np.ndarray, sketch: np.ndarray, orders: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """All candidate keys of a set: prefix hashes of short sets, register bands of the others, both in between."""
    n, parts = len(h), []
    if n < SHORT_MOST:
        parts.append(_mix(h[:n - -(-percent * n // 100) + 1] ^ np.uint64(0x5851F42D4C957F2D)))
    if n >= SHORT_LEAST:
        parts.append(band_keys(sketch, orders))
    return np.concatenate(parts)


def chance_matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers expected to agree by chance between sketches of unrelated sets of ``a`` and ``b`` elements."""
    x, y = a / REGISTERS, b / REGISTERS
    total = np.zeros(len(x))
    for zeros in range(48):  # least hash of a bucket in [2^-(zeros+1), 2^-zeros), cut into mantissa cells
        lo = 2.0 ** -(zeros + 1)
        total += lo / (1 << MANTISSA) * (np.exp(-(x + y) * lo) - np.exp(-(x + y) * 2 * lo))
    return REGISTERS * x * y / (x + y) * total


def occupied(sketches: np.ndarray) -> np.ndarray:
    """The occupied registers of each sketch as a row of bits in 64-bit words."""
    return np.packbits(sketches > 0, axis=1).view(np.uint64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers that are equal in each pair of sketches: 256 one-byte answers, added as 32 words of eight bytes."""
    eight = (a == b).view(np.uint64).sum(axis=1, dtype=np.uint64)
    four = (eight & np.uint64(0x00FF00FF00FF00FF)) + (eight >> np.uint64(8) & np.uint64(0x00FF00FF00FF00FF))
    return (four * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64)


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int = PERCENT, used=None) -> np.ndarray:
    """Whether pairs of sketches (rows of ``a`` and ``b``; ``used``: what ``occupied`` gives for the two) can belong to sets of the wanted similarity: sizes allow it and
    the collision-corrected estimate is not below it by more than ``SIGMAS`` standard deviations. Buckets sample the
    union, so the deviation shrinks where nearly every element of the union has a bucket of its own."""
    goal = percent / 100
    ua, ub = (occupied(a), occupied(b)) if used is None else used
    bits = np.bitwise_count(ua | ub)
    both_empty = REGISTERS - (bits[:, 0].astype(np.int64) + bits[:, 1] + bits[:, 2] + bits[:, 3])
    same, filled = agreeing(a, b) - both_empty, np.maximum(REGISTERS - both_empty, 1)
    union = (na + nb) / (1 + goal)
    sigma = np.sqrt(goal * (1 - goal) / filled * np.maximum(1 - filled / union, 0))
    least = (goal - SIGMAS * sigma) * filled - 2
    ok = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (same >= least)
    near = np.flatnonzero(ok)  # the correction only lowers an estimate: the others need none
    if len(near):
        ok[near] = same[near] - chance_matches(na[near].astype(float), nb[near].astype(float)) >= least[near]
    return ok


def add_sets(df: DataFrame, id_col: str, text: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(rid, id, text, n, node, sketch, keys) of each row: ``node`` is a hash of the set, null for an empty one."""
    base = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text).alias("text"))

    def run(batches):
        import xxhash

        orders = bucket_orders()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n, node, sketch, keys = [], [], [], []
                for t in part.column(2).to_pylist():
                    h = set_hashes(shingle_set(t, shingle))
                    n.append(len(h))
                    if not len(h):
                        node.append(None), sketch.append(None), keys.append(None)
                        continue
                    regs = registers(h)
                    node.append(int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).view(np.int64)))
                    sketch.append(regs.tobytes())
                    keys.append(keys_of(h, regs, orders, percent).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sketch, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["rid", "id", "text", "n", "node", "sketch", "keys"])

    kind = dict(base.dtypes)["id"]
    return base.mapInArrow(run, f"rid long, id {kind}, text string, n long, node long, sketch binary, keys array<long>")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def estimated(pairs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose sketches may belong to linked sets."""
    side = reps.select("node", "n", "sketch")
    both = (pairs.join(side.toDF("u", "nu", "su"), "u").join(side.toDF("v", "nv", "sv"), "v")
            .select("u", "v", "nu", "nv", "su", "sv"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                ok = may_link(_matrix(b.column(4)), _matrix(b.column(5)), b.column(2).to_numpy(), b.column(3).to_numpy(), percent)
                yield b.select(["u", "v"]).filter(pa.array(ok))

    return both.mapInArrow(run, "u long, v long")


def texts_of(pairs: DataFrame, sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, text): one text of each set that occurs in ``pairs``."""
    named = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    rows = reps.select("node", "rid").join(named, "node", "left_semi").select("rid", "node")
    return sets.select("rid", "text").join(rows, "rid").select("node", "text")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    both = (pairs.join(texts.toDF("v", "tv"), "v").join(texts.toDF("u", "tu"), "u").select("u", "v", "tu", "tv"))

    def run(batches):
        last, own = None, set()
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                ok = []
                for u, tu, tv in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if u != last:
                        last, own = u, shingle_set(tu, shingle)
                    other = shingle_set(tv, shingle)
                    common = len(own & other)
                    ok.append(100 * common >= percent * (len(own) + len(other) - common))
                yield part.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def _by_cell(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(cell)`` for all rows of each cell (k, p, q first), streamed: a worker holds one cell and one batch."""
    def run(batches):
        held = None  # rows of the cell that may go on in the next batch
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            at = np.column_stack([t.column(i).to_numpy() for i in range(3)])
            cut = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1)]
            for lo, hi in zip(cut, cut[1:]):
                yield from work(t.slice(lo, hi - lo))
            held = t.slice(cut[-1]).combine_chunks()
        if held is not None:
            yield from work(held)

    return rows.repartition("k", "p", "q").sortWithinPartitions("k", "p", "q", "node").mapInArrow(run, schema)


def _earlier(lists: pa.ListArray) -> np.ndarray:
    """For each list of keys the ones that it shares, as a row of bits: the ``EARLIER`` keys held most often."""
    flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    values, code, held = np.unique(flat, return_inverse=True, return_counts=True)
    most = np.argsort(-held, kind="stable")[:EARLIER]
    most = most[held[most] > 1]
    place = np.full(len(values), -1)
    place[most] = np.arange(len(most))
    at = place[code]
    out = np.zeros((len(lists), EARLIER), dtype=bool)
    out[np.repeat(np.arange(len(lists)), size)[at >= 0], at[at >= 0]] = True
    return np.packbits(out, axis=1).view(np.uint64)


def _cell_candidates(cell: pa.Table, regs: np.ndarray, percent: int, earlier: np.ndarray | None = None):
    """(i, j) arrays, some rows at a time, of the pairs of a cell (k, p, q, x, node, c, n, ..) that lie in different
    components and may link: each pair once, inside one block by position, between two blocks from one to the other.
    Pairs that share a bit of ``earlier`` are left to the cells of that key."""
    m = cell.num_rows
    one = cell.column(1)[0].as_py() == cell.column(2)[0].as_py()
    x, c, n = (cell.column(i).to_numpy() for i in (3, 5, 6))
    low = x == cell.column(1)[0].as_py()
    used = occupied(regs)
    rows = max(1, BLOCK * 32 // m)
    for lo in range(0, m, rows):
        i, j = np.indices((min(rows, m - lo), m)).reshape(2, -1)
        i = i + lo
        ok = (c[i] != c[j]) & ((i < j) if one else (low[i] & ~low[j]))
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        if earlier is not None:
            ok = ~(earlier[i] & earlier[j]).any(axis=1)
            i, j = i[ok], j[ok]
        ok = may_link(regs[i], regs[j], n[i], n[j], percent, (used[i], used[j]))
        yield i[ok], j[ok]


def _spanning_links(cell: pa.Table, percent: int):
    """Links of a cell whose column 7 holds the sets' hashes: those that join components, none that closes a circle."""
    sets = [np.frombuffer(h, dtype=np.uint64) for h in cell.column(7).to_pylist()]
    regs = np.stack([registers(h) for h in sets])
    node, c, n = (cell.column(i).to_numpy() for i in (4, 5, 6))
    sizes = np.array([len(h) for h in sets])
    starts = np.cumsum(sizes) - sizes
    words, code = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(words), dtype=np.uint8)
    root = c.copy()  # components as joined so far in this cell
    for i, j in _cell_candidates(cell, regs, percent):
        for a in np.unique(i):
            others = j[i == a]
            others = others[root[others] != root[a]]
            if not len(others):
                continue
            own = code[starts[a]:starts[a] + sizes[a]]
            mark[own] = 1
            if 8 * len(others) > len(sizes):  # one pass over the cell's sets
                common = np.add.reduceat(mark[code], starts, dtype=np.int64)[others]
            else:
                common = np.array([int(mark[code[starts[b]:starts[b] + sizes[b]]].sum()) for b in others])
            mark[own] = 0
            for b in others[100 * common >= percent * (n[a] + n[others] - common)]:
                if root[a] != root[b]:
                    root[root == root[b]] = root[a]
                    yield int(min(node[a], node[b])), int(max(node[a], node[b]))


def late_links(members: DataFrame, texts: DataFrame, reps: DataFrame, shingle: int = SHINGLE, block: int = BLOCK,
               percent: int = PERCENT) -> DataFrame:
    """(u, v) links between components among the members (k, node, c) of keys that hold several components ``c``. Members are
    dealt into blocks by hash, one cell for each pair of blocks. A pair is compared under the least key that it shares: of
    different components, it shares no key but those of ``members`` and keys of its own, which have compared it. Sketches first name, in each cell, the members that may
    link to another component; only their whole sets are then brought to the cell and compared, and of
    the links found a cell returns those that join components."""
    size = members.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi")).where(
        "lo < hi").select("k", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    dealt = members.join(size, "k").withColumn("x", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = dealt.select("k", F.explode(F.expr(
        "transform(sequence(0, blocks - 1), y -> struct(least(x, y) AS p, greatest(x, y) AS q))")).alias("cell"),
        "x", "node", "c").join(reps.select("node", "n", "sketch", "keys"), "node").select(
        "k", "cell.p", "cell.q", "x", "node", "c", "n", "sketch", F.expr("filter(keys, y -> y < k)").alias("earlier"))

    def candidates(cell):
        if cell.num_rows > 1:
            busy = np.zeros(cell.num_rows, dtype=bool)
            regs, earlier = _matrix(cell.column(7).combine_chunks()), _earlier(cell.column(8).combine_chunks())
            for i, j in _cell_candidates(cell, regs, percent, earlier):
                busy[i] = busy[j] = True
            if busy.any():
                yield from cell.select(range(7)).filter(pa.array(busy)).to_batches()

    busy = cut_lineage(_by_cell(cells, candidates, "k long, p int, q int, x int, node long, c long, n long"))
    named = texts.join(busy.select("node").distinct(), "node", "left_semi")

    def hashed(batches):
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                h = [set_hashes(shingle_set(t, shingle)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(h, pa.binary())], names=["node", "set"])

    whole = busy.join(named.mapInArrow(hashed, "node long, set binary"), "node").select(
        "k", "p", "q", "x", "node", "c", "n", "set")

    def links(cell):
        found = list(_spanning_links(cell, percent))
        if found:
            u, v = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    out = cut_lineage(_by_cell(whole, links, "u long, v long").distinct())
    release(busy)
    return out


def component_of(reps: DataFrame, links: DataFrame) -> DataFrame:
    """(node, c): the component of every set, itself if it has no link."""
    comps = connected_components(links)
    return reps.select("node").join(comps, "node", "left").select("node", F.coalesce("component", "node").alias("c"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of ``df``: the size of its set, the least id of all documents
    reachable by links, and whether that is its own id."""
    sets = cut_lineage(add_sets(df, id_col, text, shingle, percent))
    least = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"), F.min("rid").alias("rid"))
    reps = cut_lineage(sets.select("rid", "n", "sketch", "keys").join(least, "rid"))

    rows = cut_lineage(sets.select("id", "n", "node"))

    keys = reps.select(F.explode("keys").alias("k"), "node")
    shared = cut_lineage(keys.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("a"), F.max("node").alias("b"))
                         .where("m > 1"))
    crowd = keys.join(shared.where("m > 2").select("k", "a"), "k")
    first = cut_lineage(shared.where("m = 2").select(F.col("a").alias("u"), F.col("b").alias("v"))
                        .unionAll(crowd.where("node <> a").select(F.col("a").alias("u"), F.col("node").alias("v"))).distinct())
    texts = cut_lineage(texts_of(first, sets, reps))
    release(sets)
    links = cut_lineage(confirmed(estimated(first, reps, percent), texts, shingle, percent))

    # keys of three or more: what the least member does not link may still link with one another
    comps = cut_lineage(component_of(reps, links))
    members = crowd.select("k", "node").join(comps, "node")
    late = late_links(members, texts, reps, shingle, block, percent)
    joined = (late.join(comps.toDF("u", "cu"), "u").join(comps.toDF("v", "cv"), "v")
              .select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    merged = connected_components(joined).toDF("c", "root")
    final = comps.join(merged, "c", "left").select("node", F.coalesce("root", "c").alias("c"))
    named = reps.select("node", "least").join(final, "node")
    roots = cut_lineage(named.join(named.groupBy("c").agg(F.min("least").alias("component_id")), "c").select(
        "node", "component_id"))
    out = _result(rows, roots, id_col)
    for spent in (reps, shared, first, texts, links, comps, late):
        release(spent)
    return out


def _result(sets: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    rows = sets.select("id", "n", "node").join(roots, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose id names their component, and rows without an id."""
    kept, tag = near_duplicates(df, id_col, text), free_name(df, "__kept_id")
    ids = kept.where("kept").select(F.col(id_col).alias(tag)).distinct()
    return df.join(ids, F.col(id_col) == F.col(tag), "left_semi").unionByName(df.where(F.col(id_col).isNull()))
