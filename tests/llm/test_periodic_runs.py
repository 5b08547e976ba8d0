"""Periodic runs against a plain search over all periods, and the query against its contract word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.llm import periodic_runs, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(s, min_length, min_exponent):
    """Every period from small to great: maximal stretches of words equal to the word a period on."""
    out, seen = [], set()
    for q in range(1, len(s) // min_exponent + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(rnd):
    n, letters = rnd.randint(0, 70), rnd.choice([1, 2, 3, 6])
    s = [rnd.randrange(letters) for _ in range(n)]
    if n and rnd.random() < 0.6:
        a, p = rnd.randrange(n), rnd.randint(1, 9)
        s = [s[i] if i < a or a + (i - a) % p >= n else s[a + (i - a) % p] for i in range(n)]
    return s


@pytest.mark.parametrize("limits", [(1, 2), (1, 3), (24, 3), (8, 4)])
def test_runs_equal_search_over_all_periods(limits):
    rnd = random.Random(11)
    for _ in range(700):
        s = planted(rnd)
        assert periodic_runs.find_runs(np.array(s, dtype=np.int64), *limits) == brute_runs(s, *limits), s


def test_runs_of_regular_words():
    fib = [0], [0, 1]
    while len(fib[1]) < 600:
        fib = fib[1], fib[1] + fib[0]
    for s in (fib[1], [bin(i).count("1") % 2 for i in range(512)], [0] * 3000, [i % 7 for i in range(3000)]):
        assert periodic_runs.find_runs(np.array(s), 1, 2) == brute_runs(s, 1, 2)


def contract(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 24, 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_on_small_table(spark, tmp_path):
    rnd = random.Random(2)
    texts = [None, "", " \t\n ", "one", "x " * 400, "a b c " * 9, "café z \U0001f600 " * 12, "no\x0brun\x0chere", "w" * 9000]
    texts += [" ".join(f"w{x}" for x in planted(rnd)) for _ in range(60)]
    texts += [" ".join(f"w{rnd.randrange(90)}" for _ in range(rnd.randint(30, 600))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 30), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("Repetition", F.lit("x"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, registry.op11(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((contract(i, t) for i, t in rows), key=str)
    kept = periodic_runs.add_runs(df)
    assert kept.columns[:len(df.columns)] == df.columns and len(kept.columns) == len(df.columns) + 1
    assert periodic_runs.add_runs(df.limit(0)).count() == 0


def test_texts_share_a_suffix_array_without_crossing(spark, monkeypatch):
    texts = ["a b " * 20, "b a " * 20, "c", "a b " * 20 + "c " * 30]
    monkeypatch.setattr(periodic_runs, "SLICE", 50)
    small = list(periodic_runs._treat(texts, 24, 3))
    monkeypatch.setattr(periodic_runs, "SLICE", 1 << 16)
    assert small == list(periodic_runs._treat(texts, 24, 3))
    assert [r for _, r, _ in small] == [brute_runs(t.split(), 24, 3) for t in texts]


def test_limits_are_checked(spark):
    with pytest.raises(ValueError):
        periodic_runs.add_runs(spark.range(1).selectExpr("'a' AS text"), min_exponent=1)
