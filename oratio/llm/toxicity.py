"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

Features are the distinct words of a text and their beginnings of 4 to 7 letters. Those whose document
frequency differs between the labels beyond chance (log-odds with a prior, z-score) enter the
model. A label column with grades (0, 1, 2, ...) is fitted as it is. From a binary label the grades are 0 for a document not labelled
toxic and 1, 2 or 3 for a toxic one by the tercile of its out-of-fold score: ``FOLDS`` folds by hash of the id, each scored
by a binary model screened and fitted on the other folds, so no text takes part in its own grade. The
model is P(grade <= k) = logistic(theta_k - w.x): one weight per feature for all thresholds,
thresholds kept in order, fitted by accelerated proximal gradient with an L1 penalty. ``severity`` is
the expected grade, the sum of P(grade >= k).

The fit takes a bounded sample of labelled rows (``MAX_LABELLED``, by hash of the id, one task, to which a text comes as its
distinct words); scoring is a map over all whole texts with the word weights (at most the sample's vocabulary) in the closure.
The model rows also hold ``rank_correlation``: Spearman's, between the severity and the held-out score of the toxic documents.

Defined cases: null or wordless texts score the intercepts only; repeated rows score alike; rows
without a label are scored but not fitted; labels that are null are ignored, of several labels
of an id the highest counts, a label below 0 is 0; without any toxic or any clean label the severity is 0 everywhere; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_name

MAX_LABELLED = 10_000
GRADES = 4
LEAST_DOCS = 4     # a feature must stand in so many sampled documents
SCREEN_Z = 3.0     # and differ in document frequency between the labels by so many standard errors
PENALTY = 0.5
STEPS = 300
FOLDS = 5
FOLD_STEPS = 100
PREFIXES = (4, 5, 6, 7)
MEMO_WORDS = 300_000


def forms(word: str) -> list[str]:
    """The features of a word: itself and its beginnings (marked), which stand for its inflections."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def words_of(text: str | None) -> set[str]:
    import re

    return set(re.findall(r"[^\W\d_]{2,}", (text or "").lower()))


def features_of(text: str | None) -> set[str]:
    return {f for w in words_of(text) for f in forms(w)}


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def log_odds(toxic: np.ndarray, row: np.ndarray, idx: np.ndarray, n_words: int):
    """(log-odds of document frequency under the two labels, its z-score), with a prior of one half."""
    in_toxic = np.bincount(idx, toxic[row], minlength=n_words)
    in_all = np.bincount(idx, minlength=n_words).astype(float)
    t, c = toxic.sum(), len(toxic) - toxic.sum()
    a, b = in_toxic + 0.5, in_all - in_toxic + 0.5
    odds = np.log(a / (t + 1 - a)) - np.log(b / (c + 1 - b))
    return odds, odds / np.sqrt(1 / a + 1 / b)


def screen(toxic: np.ndarray, row: np.ndarray, idx: np.ndarray, n_words: int) -> np.ndarray:
    """Which features enter a model of these rows."""
    _, z = log_odds(toxic, row, idx, n_words)
    return (np.bincount(idx, minlength=n_words) >= LEAST_DOCS) & (np.abs(z) > SCREEN_Z)


def held_out_scores(toxic: np.ndarray, fold: np.ndarray, row: np.ndarray, idx: np.ndarray, n_words: int,
                    penalty: float = PENALTY) -> np.ndarray:
    """Log-odds of toxicity of each row by a binary model of the rows outside its fold."""
    score = np.zeros(len(toxic))
    for f in np.unique(fold):
        own = fold == f
        rest, entries = toxic[~own], ~own[row]
        if not len(rest) or rest.min() == rest.max():
            continue
        new_row = np.cumsum(~own) - 1
        r, i = new_row[row[entries]], idx[entries]
        use = screen(rest, r, i, n_words)
        keep, number = use[i], np.cumsum(use) - 1
        w, theta = fit((rest > 0).astype(int), r[keep], number[i[keep]], int(use.sum()), 2, penalty, FOLD_STEPS)
        full = np.zeros(n_words)
        full[use] = w
        mine = ~entries
        score[own] = (np.bincount(row[mine], full[idx[mine]], minlength=len(toxic)) - theta[0])[own]
    return score


def terciles(toxic: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Ordered grades: 0 if not labelled toxic, else 1 to 3 by the tercile of the score among toxic rows."""
    own = score[toxic > 0]
    cuts = np.quantile(own, [1 / 3, 2 / 3]) if len(own) else np.zeros(2)
    return np.where(toxic > 0, 1 + (score > cuts[0]).astype(int) + (score > cuts[1]), 0)


def rank_correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Spearman's coefficient, ties at their mean rank; 0 where one side is constant."""
    a, b = pd.Series(a).rank().to_numpy(), pd.Series(b).rank().to_numpy()
    return float(np.corrcoef(a, b)[0, 1]) if len(a) > 1 and a.std() and b.std() else 0.0


def fit(y: np.ndarray, row: np.ndarray, idx: np.ndarray, n_words: int, grades: int = GRADES, penalty: float = PENALTY,
        steps: int = STEPS):
    """(weights, thresholds) of the cumulative-link model; a row is a set of features. Columns are scaled to
    unit length; the step is the inverse of the curvature bound, from a few power iterations."""
    n, k = len(y), grades - 1
    scale = 1.0 / np.sqrt(np.maximum(np.bincount(idx, minlength=n_words), 1))
    s0 = 1.0 / np.sqrt(n)  # thresholds are features that every row holds

    def times(u):
        return np.bincount(row, (u * scale)[idx], minlength=n)

    def back(r):
        return np.bincount(idx, r[row], minlength=n_words) * scale

    u = np.ones(n_words)
    top = 1.0
    for _ in range(15):
        u = back(times(u / max(np.linalg.norm(u), 1e-12)))
        top = np.linalg.norm(u)
    rate = 1.0 / (0.5 * 1.1 * top + 1.0)
    share = np.clip(np.array([(y <= j).mean() for j in range(k)]), 1e-4, 1 - 1e-4)
    w, th = np.zeros(n_words), np.log(share / (1 - share)) + np.arange(k) * 1e-3
    v, vt, t_old = w.copy(), th.copy(), 1.0
    for _ in range(steps):
        s = times(v)
        a = _sigmoid(np.append(vt, np.inf)[y] - s)
        b = _sigmoid(np.concatenate([[-np.inf], vt])[y] - s)
        p = np.maximum(a - b, 1e-9)
        d_up, d_low = a * (1 - a) / p, b * (1 - b) / p
        g_th = np.array([d_low[y == j + 1].sum() - d_up[y == j].sum() for j in range(k)]) * s0
        new = v - rate * back(1 - a - b)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_th = np.maximum.accumulate(vt - rate * g_th * s0 + np.arange(k) * 1e-9)  # thresholds stay in order
        t = (1 + np.sqrt(1 + 4 * t_old * t_old)) / 2
        v, vt = new + (t_old - 1) / t * (new - w), np.maximum.accumulate(new_th + (t_old - 1) / t * (new_th - th))
        w, th, t_old = new, new_th, t
    return w * scale, th


def severity_of(score: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ...; their sum is the expected grade."""
    return _sigmoid(score[:, None] - theta[None, :])


MODEL = "kind string, word string, value double"


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Model rows (word weights that are not 0, thresholds), fitted in one task on the bounded sample."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label).cast("int")).alias("__y"))
    total = known.count()
    if total > max_labelled:  # by hash, so the same rows whatever the partitioning
        known = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int((1 << 20) * max_labelled / total))
    @F.pandas_udf("array<string>")
    def distinct_words(t: pd.Series) -> pd.Series:
        return pd.Series([sorted(words_of(x)) for x in t])

    sample = docs.join(F.broadcast(known), id_col).select(F.col(id_col).cast("string").alias("id"), distinct_words(text).alias("w"), "__y")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        from array import array
        from zlib import crc32

        rows = sorted((i, tuple(w), y) for i, w, y in zip(pdf["id"], pdf["w"], pdf["__y"]))
        number, flat, sizes = {}, array("i"), []
        for _, words, _ in rows:
            f = sorted({x for w in words for x in forms(w)})
            flat.extend(number.setdefault(x, len(number)) for x in f)
            sizes.append(len(f))
        given = np.maximum(np.array([y for _, _, y in rows], dtype=int), 0)
        toxic = (given > 0).astype(float)
        if not len(toxic) or toxic.min() == toxic.max():
            return pd.DataFrame({"kind": ["none"], "word": [""], "value": [0.0]})
        idx, row = np.frombuffer(flat, dtype=np.int32), np.repeat(np.arange(len(sizes)), sizes)
        fold = np.array([crc32(i.encode()) % FOLDS for i, _, _ in rows])
        held_out = held_out_scores(toxic, fold, row, idx, len(number))
        y = given if given.max() > 1 else terciles(toxic, held_out)
        use = screen(toxic, row, idx, len(number))
        keep = use[idx]
        new = np.cumsum(use) - 1
        idx, row = new[idx[keep]], row[keep]
        w, theta = fit(y, row, idx, int(use.sum()), max(GRADES, int(y.max()) + 1))
        severity = severity_of(np.bincount(row, w[idx], minlength=len(y)), theta).sum(axis=1)
        agree = rank_correlation(severity[toxic > 0], held_out[toxic > 0])
        names = [x for x, i in number.items() if use[i]]
        at = np.flatnonzero(w)
        return pd.DataFrame({"kind": ["word"] * len(at) + ["theta"] * len(theta) + ["rank_correlation"],
                             "word": [names[i] for i in at] + [str(k) for k in range(len(theta))] + [""],
                             "value": list(w[at]) + list(theta) + [agree]})

    return sample.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(lambda pdf: solve(pdf), MODEL)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (most probable), ``toxic`` (P(grade >= 1) over one half) and ``p_toxic``, under
    the next free names."""
    rows = cut_lineage(train(docs, labels, id_col, text, label, max_labelled)).collect()  # bounded by the sample's vocabulary
    weight = {r.word: r.value for r in rows if r.kind == "word"}
    theta = np.array([r.value for r in sorted((r for r in rows if r.kind == "theta"), key=lambda r: int(r.word))])

    @F.pandas_udf("severity double, grade int, p_toxic double")
    def judge(s: pd.Series) -> pd.DataFrame:
        if not len(theta):
            return pd.DataFrame({"severity": np.zeros(len(s)), "grade": np.zeros(len(s), int), "p_toxic": np.zeros(len(s))})
        memo = {}  # word -> its features with a weight

        def score_of(t):
            found = set()
            for w in words_of(t):
                f = memo.get(w)
                if f is None:
                    f = memo[w] = tuple(x for x in forms(w) if x in weight)
                if f:
                    found.update(f)
            if len(memo) > MEMO_WORDS:
                memo.clear()
            return sum(weight[f] for f in sorted(found))

        score = np.array([score_of(t) for t in s], dtype=float)
        more = severity_of(score, theta)
        each = -np.diff(np.concatenate([np.ones((len(s), 1)), more, np.zeros((len(s), 1))], axis=1), axis=1)
        return pd.DataFrame({"severity": more.sum(axis=1), "grade": each.argmax(axis=1), "p_toxic": more[:, 0]})

    j = free_name(docs, "__judged")
    names = [free_name(docs, n) for n in ("severity", "grade", "p_toxic", "toxic")]
    out = docs.withColumn(j, judge(F.col(text)))
    for n, f in zip(names, ("severity", "grade", "p_toxic")):
        out = out.withColumn(n, F.col(j)[f])
    return out.withColumn(names[3], F.col(names[2]) >= 0.5).drop(j)
