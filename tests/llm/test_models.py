"""Toxicity model and neighbour search: held-out accuracy, recall against brute force, odd inputs."""

import random

import numpy as np
from pyspark.sql import functions as F

from oratio.llm import nn_descent, toxicity


def labelled(n=600):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(500)]
    bad = ["vile", "awful", "grosszu", "grossen", "grossach"]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(5, 120))]
        t = int(rnd.random() < 0.2)
        if t:
            for _ in range(rnd.randint(2, 6)):
                w.insert(rnd.randint(0, len(w)), rnd.choice(bad))
        docs.append((i, " ".join(w)))
        labels.append((i, t))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = labelled()
    odd = [(1000, None), (1001, ""), (1002, "vile " * 4000), (1003, "vile awful"), (1003, "vile awful"), (None, "calm")]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs + odd], "doc_id long, text string, severity int")
    lab = spark.createDataFrame(labels[:400] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.toxicity(d, lab)
    said = {r.doc_id: r for r in out.collect()}
    truth = dict(labels[400:])
    wrong = [i for i, t in truth.items() if said[i].toxic != bool(t)]
    assert len(wrong) <= 4 and len(said) == len(docs) + 5
    assert not said[1000].toxic and not said[1001].toxic and said[1003].toxic and said[1002].grade >= 0
    sev = out.columns[3]
    assert said[1003][sev] > said[1001][sev] and 0 <= said[1003][sev] <= 3
    none = toxicity.toxicity(d, lab.where("toxic = 0"))
    assert none.where("toxic").count() == 0
    assert toxicity.toxicity(d.limit(0), lab).count() == 0


def test_ordered_thresholds_and_expected_grade():
    rng = np.random.default_rng(1)
    n, k = 400, 6
    x = rng.random((n, k)) < 0.4
    s = x @ np.array([2.0, 1.0, 1.5, 0, 0, 0]) + rng.logistic(0, 0.5, n)
    y = np.digitize(s, [1.0, 2.5, 3.5])
    row, idx = np.nonzero(x)
    w, theta = toxicity.fit(y, row, idx, k, penalty=0.1)
    assert (np.diff(theta) >= 0).all() and w[:3].min() > max(0, w[3:].max())
    more = toxicity.severity_of(x @ w, theta)
    assert (np.diff(more, axis=1) <= 1e-12).all() and np.corrcoef(more.sum(axis=1), y)[0, 1] > 0.7


def test_fit_against_a_plain_solver():
    rng = np.random.default_rng(5)
    n, k, penalty = 90, 4, 1.0
    x = (rng.random((n, k)) < 0.5).astype(float)
    y = np.digitize(x @ np.array([1.5, -1.0, 0.8, 0.0]) + rng.logistic(0, 1, n), [-0.5, 0.8])
    scale = 1 / np.sqrt(x.sum(axis=0))

    def loss(p):  # u, first threshold, log of the gap: no constraint left
        z, th = x @ (p[:k] * scale), np.array([-np.inf, p[k], p[k] + np.exp(p[k + 1]), np.inf])
        below = lambda t: 1 / (1 + np.exp(-(t - z)))
        return -np.log(below(th[y + 1]) - below(th[y])).sum()

    def gradient(p):
        return np.array([(loss(p + e) - loss(p - e)) / 2e-5 for e in np.eye(k + 2) * 1e-5])

    p, rate = np.zeros(k + 2), 0.02
    for _ in range(6000):
        p = p - rate * gradient(p)
        p[:k] = np.sign(p[:k]) * np.maximum(np.abs(p[:k]) - rate * penalty, 0)
    row, idx = np.nonzero(x)
    w, theta = toxicity.fit(y, row, idx, k, grades=3, penalty=penalty, steps=4000)
    assert np.allclose(w, p[:k] * scale, atol=2e-3) and np.allclose(theta, [p[k], p[k] + np.exp(p[k + 1])], atol=2e-3)


def test_a_row_takes_no_part_in_its_held_out_score():
    docs, labels = labelled(300)
    toxic = np.array([t for _, t in labels], dtype=float)
    feats = [sorted(toxicity.features_of(t)) for _, t in docs]
    number = {f: i for i, f in enumerate(sorted({f for fs in feats for f in fs}))}
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    idx = np.array([number[f] for fs in feats for f in fs])
    fold = np.arange(300) % 5
    score = toxicity.held_out_scores(toxic, fold, row, idx, len(number))
    turned = np.where(fold == 2, 1 - toxic, toxic)  # a whole fold labelled the other way
    assert (toxicity.held_out_scores(turned, fold, row, idx, len(number))[fold == 2] == score[fold == 2]).all()
    assert ((score > 0) == (toxic > 0)).mean() > 0.95
    grades = toxicity.terciles(toxic, score)
    assert (grades[toxic == 0] == 0).all() and np.bincount(grades)[1:].min() > 0.2 * toxic.sum()
    assert abs(toxicity.rank_correlation(np.array([1, 2, 2, 9]), np.array([0.0, 3, 3, 5])) - 1) < 1e-12


def test_given_grades_are_fitted_as_they_are(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("klmnoprstu") for _ in range(5)) for _ in range(300)]
    strong = ["mild", "nasty", "dreadful"]
    docs, labels = [], []
    for i in range(500):
        g = rnd.choice([0, 0, 1, 2, 3])
        w = [rnd.choice(vocab) for _ in range(30)] + strong[:g] * (40 if i % 50 == 0 else 1)
        docs.append((i, " ".join(w)))
        labels.append((i, g))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels[:350], "doc_id long, toxic int")
    said = {r.doc_id: r for r in toxicity.toxicity(d, lab).collect()}
    assert np.mean([said[i].grade == g for i, g in labels[350:]]) > 0.9
    # the binary score of the same rows holds no order among the toxic ones ("mild" stands in all), which the report shows
    assert {r.kind for r in toxicity.train(d, lab).collect()} == {"word", "theta", "rank_correlation"}


def test_severity_follows_the_held_out_score(spark):
    docs, labels = labelled()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = {r.kind: r.value for r in toxicity.train(d, lab).collect()}
    assert 0.4 < rows["rank_correlation"] <= 1


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is None or v is None or len(v) != 16 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok[i], v) if i in ok else v
    ids = np.array(sorted(ok))
    x = np.array([ok[i] for i in ids.tolist()], dtype=np.float64)
    out = {}
    for q in ids[ids % 100 == 0].tolist():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        best = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = best
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[300:700] = x[300]  # a large group of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 16), (2200, [1.0] * 15 + [float("nan")]),
                                                        (2300, [1.0] * 15 + [None]), (2400, [1.0] * 3), (7, [9.0] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(6)
    want = brute(rows, 10)
    got = {}
    for r in nn_descent.nearest(df, F.expr("id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id, r["rank"]))
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        assert [r for _, _, r in got[q]] == list(range(1, 11))
        assert got[q] == sorted(got[q])
        reach = best[-1][0] * (1 + 1e-9)
        hits += sum(s <= reach for s, _, _ in got[q])  # equal distances count whichever id carries them
    assert hits >= 0.95 * 10 * len(want)
    few = nn_descent.nearest(df.where("vec_id <= 4"), F.expr("id % 100 = 0")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert nn_descent.nearest(df.limit(0), F.expr("id % 100 = 0")).count() == 0
