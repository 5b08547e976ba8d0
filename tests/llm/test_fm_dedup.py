"""FM-index substring dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.llm import fm_dedup


def brute(rows, window=13):
    """{(id, text): (n_words, n_removed, kept)}"""
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        if d is None:
            continue
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least.get(k, d), d)
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and least[tuple(w[i:i + window])] < d:
                gone |= set(range(i, i + window))
        out[d, t] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def corpus():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(60)] + ["the", "été", "\U0001f600"]

    def prose(n):
        return [rnd.choice(vocab) for _ in range(n)]
    passage, licence = prose(60), prose(25)
    rows = []
    for i in range(60):
        w = prose(rnd.randint(0, 80))
        if i % 3 == 0:
            w = w + passage[rnd.randint(0, 20):rnd.randint(30, 60)] + prose(rnd.randint(0, 20))
        if i % 4 == 0:
            w = licence + w
        rows.append((i * 3 % 101, " ".join(w)))
    same = " ".join(prose(40))
    rows += [(200 + i, same) for i in range(30)] + [(5, same), (5, same), (None, same), (300, None), (301, ""), (302, " \n\t "),
             (303, "x " * 200), (304, "x " * 50), (305, " ".join(prose(13))), (306, "\n".join(passage)), (5, "other " + same)]
    return rows


@pytest.mark.parametrize("hot,shard", [(20_000, 400_000), (5, 200)])
def test_remove_repeats(spark, hot, shard):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_words int").repartition(4)
    out = fm_dedup.remove_repeats(df, hot=hot, shard=shard)
    names = out.columns[3:]
    got = [((r.doc_id, r.text), tuple(r[n] for n in names)) for r in out.collect()]
    want = brute(rows)
    assert len(got) == len(rows)
    for k, v in got:
        assert v == want[k], k
    assert fm_dedup.remove_repeats(df.limit(0)).count() == 0
    clean = fm_dedup.without_repeats(df)
    assert clean.columns == df.columns and clean.count() == len(rows)


def test_streams_give_matching_statistics():
    """Most streamed windows do not match in full, and the statistic takes every value from none to the whole window."""
    rnd, depth = np.random.default_rng(2), 13
    texts = [rnd.integers(1, 5, n) for n in (5, 9, 1, 40, 60, 25)] + [np.ones(30, np.int64)]
    index = fm_dedup.FMIndex(np.concatenate(texts), np.array([len(t) for t in texts]), depth)
    parts = [rnd.integers(0, 5, 40) for _ in range(40)] + [texts[3][4:20], texts[4][:30], texts[0], np.ones(50, np.int64)]
    parts += [np.concatenate([texts[4][k:k + 3 + k % 12], [0], texts[5][k % 9:k % 9 + 12]]) for k in range(40)]
    words, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    matched, lo, hi = index.stream(words, sizes)

    def count(p):
        return sum((t[i:i + len(p)] == p).all() for t in texts for i in range(len(t) - len(p) + 1))
    ends = np.cumsum(sizes)
    for pos, (m, a, b) in enumerate(zip(matched, lo, hi)):
        most = min(depth, ends[np.searchsorted(ends, pos, side="right")] - pos)
        assert m == max(k for k in range(most + 1) if k == 0 or count(words[pos:pos + k]))
        assert m == 0 or b - a == count(words[pos:pos + m])
    assert set(matched.tolist()) == set(range(depth + 1)) and (matched < depth).mean() > 0.5


def test_first_ids_of_a_shard():
    rnd = np.random.default_rng(5)
    segs = [rnd.integers(0, 3, rnd.integers(4, 12)).astype(np.uint64) for _ in range(120)]
    ids, groups, window = rnd.integers(0, 60, 120), np.zeros(120, np.uint64), 4
    firsts, n_win = fm_dedup.first_ids(np.concatenate(segs), np.array([len(x) for x in segs]), ids, groups, window)
    least = {}
    for x, d in zip(segs, ids):
        for i in range(len(x) - window + 1):
            least[tuple(x[i:i + window])] = min(least.get(tuple(x[i:i + window]), d), d)
    want = [least[tuple(x[i:i + window])] for x in segs for i in range(len(x) - window + 1)]
    assert firsts.tolist() == want and n_win.tolist() == [max(0, len(x) - window + 1) for x in segs]


def test_batches_are_treated_in_bounded_slices():
    import pyarrow as pa

    rows = [[1] * 3, [], [2] * 50, [3] * 4, [4] * 5, [], [5]]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], names=["w"])
    got = [b.column("w").to_pylist() for b in fm_dedup._bounded([batch, batch.slice(2, 3)], 9)]
    assert [r for b in got for r in b] == rows + rows[2:5]
    assert all(len(b) == 1 or sum(map(len, b)) <= 9 for b in got)
    assert [len(b) for b in got] == [2, 1, 3, 1, 1, 2]


@pytest.mark.parametrize("window,hot", [(50, 20_000), (50, 5), (21, 20_000)])
def test_wide_windows(spark, window, hot):
    rnd = random.Random(3)
    prose = [f"w{rnd.randint(0, 5000)}" for _ in range(400)]
    rows = [(i, " ".join([f"a{i}"] * i + prose[7 * i:7 * i + 120] + [f"z{i}"] * 5)) for i in range(30)] + corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, window)
    assert sum(v[1] for v in want.values()) > 1000
    for r in fm_dedup.remove_repeats(df, window=window, hot=hot).collect():
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id, r.text]
