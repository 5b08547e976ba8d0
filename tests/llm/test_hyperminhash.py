"""HyperMinHash near-duplicates against all pairs, and its sketches against plain Python."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.llm import hyperminhash as hm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(t):
    w = [x.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) for x in WORD.findall(t or "")]
    return {(w[0],)} if len(w) == 1 else set(zip(w, w[1:]))


def brute(rows, percent=80):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i)), d is not None and d == least.get(find(i))) for i, (d, _) in enumerate(rows)]


def corpus():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    out = []
    for size in (3, 5, 6, 9, 15, 40, 70, 90, 200, 700):
        for _ in range(3):
            base = [rnd.choice(vocab) for _ in range(size)]
            out.append(base)
            for _ in range(9):  # near copies around the threshold, exact copies among them
                t = list(base)
                for _ in range(rnd.randint(0, max(1, size // 9))):
                    t[rnd.randrange(len(t))] = rnd.choice(vocab)
                out.append(t)
    texts = [" ".join(t) for t in out]
    texts += [None, "", " \n\t ", "one", "One", "a b", "A B", "a b c", "b a", "same pair " * 3000, "café Été", "z" * 7000]
    texts += [f"shared start {i} {i + 1} {i + 2} {i + 3}" for i in range(40)]  # a frequent shingle among short sets
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return rows + [rows[5], (None, rows[7][1]), (None, "alone here"), (None, None)]


def as_rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("block", [4, 1024])
def test_components_equal_all_pairs(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("Keys", F.lit("x"))
    assert as_rows(hm.near_duplicates(df, block=block)) == sorted(brute(rows), key=str)


def test_empty_and_kept(spark):
    rows = [(1, "a b c d"), (2, "A b c d"), (3, "e f"), (None, "e f"), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__kept_id", F.lit(0))
    assert hm.near_duplicates(df.limit(0)).count() == 0
    kept = hm.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (tuple(r)[:2] for r in kept.collect()))) == sorted(map(str, [rows[0], rows[2], rows[3], rows[4], rows[5]]))


def test_registers_are_leading_zeros_and_mantissa():
    rnd = random.Random(4)
    h = np.array(sorted({rnd.getrandbits(64) >> rnd.choice([0, 0, 0, 9, 30]) for _ in range(900)}), dtype=np.uint64)
    want = [0] * hm.REGISTERS
    least = {}
    for x in map(int, h):
        b, rest = x >> 56, x & ((1 << 56) - 1)
        least[b] = min(least.get(b, rest), rest)
    for b, rest in least.items():
        bits = f"{rest:056b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        mantissa = (bits.lstrip("0")[1:] + "0" * hm.MANTISSA)[:hm.MANTISSA]
        want[b] = (min(zeros, 62) + 1 << hm.MANTISSA) + int(mantissa, 2)
    if 0 not in least.values():
        assert hm.registers(h).tolist() == want


def test_similar_sets_share_a_key_and_pass_the_estimate():
    rnd, orders = random.Random(6), hm.bucket_orders()
    for _ in range(800):
        size = rnd.choice([4, 5, 6, 10, 30, 62, 66, 79, 81, 120, 600])
        a = {rnd.getrandbits(60).to_bytes(8, "big") for _ in range(size)}
        b = set(a)
        while True:  # as far apart as the threshold allows
            c = set(b)
            c.discard(rnd.choice(sorted(c))) if rnd.random() < 0.5 else c.add(rnd.getrandbits(60).to_bytes(8, "big"))
            if 100 * len(a & c) < 80 * len(a | c):
                break
            b = c
        ha, hb = hm.set_hashes(a), hm.set_hashes(b)
        ra, rb = hm.registers(ha), hm.registers(hb)
        assert set(hm.keys_of(ha, ra, orders).tolist()) & set(hm.keys_of(hb, rb, orders).tolist())
        assert hm.may_link(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0]


def test_estimate_is_corrected_and_rejects_unrelated_sets():
    rnd, orders = random.Random(7), hm.bucket_orders()
    same, expected, shared = 0, 0.0, 0
    for _ in range(150):
        a, b = (np.array(sorted(rnd.getrandbits(64) for _ in range(3000)), dtype=np.uint64) for _ in range(2))
        ra, rb = hm.registers(a), hm.registers(b)
        same += int(((ra == rb) & (ra > 0)).sum())
        expected += float(hm.chance_matches(np.array([3000.0]), np.array([3000.0]))[0])
        shared += len(set(hm.keys_of(a, ra, orders).tolist()) & set(hm.keys_of(b, rb, orders).tolist()))
        assert not hm.may_link(ra[None], rb[None], np.array([3000]), np.array([3000]))[0]
    assert shared == 0 and abs(same - expected) <= 5 * expected ** 0.5 + 5


def test_a_pair_of_several_keys_is_compared_in_one_cell():
    import pyarrow as pa

    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(200)]
    sets = [np.array(sorted(base[:190] + [rnd.getrandbits(64) for _ in range(10)]), dtype=np.uint64) for _ in range(6)]
    regs = np.stack([hm.registers(h) for h in sets])
    cell = pa.table({"k": [7] * 6, "p": [0] * 6, "q": [0] * 6, "x": [0] * 6, "node": list(range(6)), "c": list(range(6)),
                     "n": [200] * 6})
    # the first three share key 5 as well, the last three share no key below 7
    earlier = hm._earlier(pa.array([[5, 1], [5, 2], [5, 3], [4], [], [6]], pa.list_(pa.int64())))
    pairs = [(int(a), int(b)) for i, j in hm._cell_candidates(cell, regs, 80, earlier) for a, b in zip(i, j)]
    assert sorted(pairs) == [(a, b) for a in range(6) for b in range(a + 1, 6) if b > 2]


def test_stars_need_no_second_round(spark, monkeypatch):
    from oratio.llm import components

    written = []
    cut = components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df: written.append(1) or cut(df))
    edges = spark.createDataFrame([(5, 1), (1, 4), (4, 4), (9, 7), (5, 1), (None, 3)], "u long, v long")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert got == {1: 1, 4: 1, 5: 1, 7: 7, 9: 7} and len(written) == 1
