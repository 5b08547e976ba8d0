"""BM25 of a shard against plain Python, before and after used remainders leave the postings; order of equal scores."""

import math
import random
import string
import zlib

import numpy as np

from oratio.llm import packing


def bm25(pieces, df, docs, mean, query):
    out = []
    for p in pieces:
        total = 0.0
        for t in sorted(set(query.tolist())):
            tf = p.tolist().count(t)
            idf = math.log1p((docs - df[t] + 0.5) / (df[t] + 0.5))
            total += idf * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(p) / mean))
        out.append(total)
    return np.array(out)


def test_scores_equal_plain_bm25_while_remainders_are_used():
    rng = np.random.default_rng(3)
    pieces = [rng.zipf(1.4, size=rng.integers(1, 80)).clip(0, 199).astype(np.uint16) for _ in range(120)]
    df = np.zeros(200, np.int64)
    for p in pieces:
        df[np.unique(p)] += 1
    mean = float(np.mean([len(p) for p in pieces]))
    index = packing.Index(pieces, df, 120, mean)
    unused = np.ones(120, dtype=bool)
    for step in range(12):
        index.drop_used(unused)
        query = np.unique(pieces[step])
        got, want = index.scores(query), bm25(pieces, df, 120, mean, query)
        assert np.allclose(got[unused], want[unused])
        assert np.count_nonzero(unused) <= index.live and np.count_nonzero(unused) * 8 > index.live * 7
        unused[rng.choice(np.flatnonzero(unused), 9, replace=False)] = False
    assert index.live < 40 and len(index.doc) < 40 * 80
    assert not packing.Index(pieces, df, 120, mean).scores(np.array([], np.int64)).any()


def test_best_first_is_the_stable_order():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 31, 32, 33, 700, 4000):
        score = rng.integers(-1, 40, n).astype(float)
        assert list(packing.best_first(score)) == np.argsort(-score, kind="stable").tolist()


def test_digest_is_the_checksum_of_the_ids(spark):
    raw = np.array([1, 70_000, 5], "<u4").tobytes()
    pieces = spark.createDataFrame([(7, 0, 3, bytearray(raw), 3, 9, 0)], packing.PIECES)
    assert packing.digest(pieces).select("ids_crc32").first()[0] == zlib.crc32(raw)


def test_a_piece_is_looked_up_once_a_chunk():
    from collections import Counter

    from oratio.llm.tokens import TextEncoder, default_path

    asked = Counter()

    class Memo(dict):
        def get(self, key, default=None):
            asked[key] += 1
            return super().get(key, default)

    enc = TextEncoder(default_path())
    enc.memo = Memo(enc.memo)
    got = enc(["the same words, the same words."] * 50)
    want = enc.tok.encode("the same words, the same words.", add_special_tokens=False).ids
    assert all(np.frombuffer(g, enc.dtype).tolist() == want for g in got)
    assert max(asked.values()) == 1


def test_words_with_punctuation_behind_are_learnt_by_the_model():
    from oratio.llm.tokens import TextEncoder, default_path

    rnd = random.Random(5)
    enc = TextEncoder(default_path())
    words = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 9))) + "".join(rnd.choices(string.punctuation, k=rnd.randint(1, 4)))
             for _ in range(3000)]
    want = [enc.tok.encode(w, add_special_tokens=False).ids for w in words]
    together = enc.tok.encode(" ".join(words), add_special_tokens=False).ids
    enc.memo, enc.spill = {}, {}
    enc._start()
    whole = []
    encode = enc._whole
    enc._whole = lambda texts: whole.extend(texts) or encode(texts)
    assert [np.frombuffer(g, enc.dtype).tolist() for g in enc(words)] == want
    assert np.frombuffer(enc([" ".join(words)])[0], enc.dtype).tolist() == together
    assert sum(map(len, whole)) < 100  # the slower way takes none of them
