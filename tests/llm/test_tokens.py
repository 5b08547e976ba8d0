"""Token files and packing: exact round trips against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.llm import packing, token_file
from oratio.llm.tokens import TextEncoder, default_path, load_tokenizer

TEXTS = [None, "", " ", "  ", "a  b", " a", "a ", "x\n\ny", "x \n y", "x\n y", "tab\t z", "one two 　 three", "été \U0001f600 \U0001f600",
         "don't we'll", "<|endoftext|> in text", "a\x1cb \x1f c", "word " * 3000, "z" * 9000, "same text here", "same text here"]


def documents(spark):
    rnd = random.Random(2)
    vocab = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    texts = TEXTS + [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 1500))) for _ in range(60)]
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no id")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).repartition(5)


def encode(t):
    return load_tokenizer(default_path()).encode(t or "", add_special_tokens=False).ids


def test_encoder_equals_library():
    rnd = random.Random(9)
    parts = [" ", ",", ".\nB", "\n\n", "  ", "\n", "\t", " ", "a", "b'", "'s", "1", "é", "!", "\x1c", " ", "<|endoftext|>", "the"]
    texts = TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    enc = TextEncoder(default_path(), memo_words=500)
    got = enc(texts) + enc(texts)
    want = [encode(t) for t in texts]
    assert [np.frombuffer(g, enc.dtype).tolist() for g in got] == want + want


def test_codec_round_trip_and_damage():
    rng = np.random.default_rng(4)
    for n in (1, 5, 64, 130, 4000, 70_000):
        ids = rng.zipf(1.3, n) % 5000
        freq = token_file.scaled_table(np.bincount(ids, minlength=5000))
        assert freq.sum() == 1 << token_file.SCALE and (freq[np.unique(ids)] > 0).all()
        payload = token_file.encode_block(ids, freq, lanes=64, checkpoint=16)
        tables = token_file.decode_tables(freq)
        assert (token_file.decode_block(payload, tables) == ids).all()
        lanes = min(64, 1 << max(0, (n // 64).bit_length() - 1))
        k = (-(-n // lanes) - 1) // 16  # the last stretch alone
        assert (token_file.decode_stretch(payload, k, tables) == ids[k * 16 * lanes:]).all()
        bad = bytearray(payload)
        bad[len(bad) // 2] ^= 1
        with pytest.raises(ValueError):
            token_file.decode_block(bytes(bad), tables)


@pytest.mark.parametrize("block", [3000, 1 << 20])
def test_token_file(spark, block):
    rows, df = documents(spark)
    path = token_file.write_token_file(df, token_file.fresh_path(spark), default_path(), 2, block=block)
    got = sorted(token_file.read_token_file(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    at = 0
    for r, (_, t) in zip(got, order):
        ids = np.array(encode(t) + [2], "<u4").tobytes()
        assert (r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (at, len(ids) // 4, ids, zlib.crc32(ids))
        at += r.n_tokens
    empty = token_file.write_token_file(df.limit(0), token_file.fresh_path(spark), default_path(), 2)
    assert token_file.read_token_file(spark, empty).count() == 0


@pytest.mark.parametrize("window,shard", [(64, 7), (2048, 512)])
def test_packing(spark, window, shard):
    rows, df = documents(spark)
    pieces = packing.pack(df, default_path(), 1, window=window, shard=shard).collect()
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(encode(t) + [1])
    # each id of each document lies in exactly one piece
    by_doc = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(ids) == p.length
        by_doc[p.doc_id, p.doc_tokens].append((p.start, ids))
    flat = defaultdict(list)
    for (d, n), ps in by_doc.items():
        ps.sort(key=lambda x: (x[0], x[1]))
        copies = sum(1 for x in want[d] if len(x) == n)
        assert sum(len(i) for _, i in ps) == copies * n
        if copies == 1:
            assert [x for _, i in ps for x in i] == next(x for x in want[d] if len(x) == n)
            assert [s for s, _ in ps] == np.concatenate([[0], np.cumsum([len(i) for _, i in ps])[:-1]]).tolist()
        flat[d].append(copies)
    assert {d: sum(c) for d, c in flat.items()} == {d: len(x) for d, x in want.items()}
    # offsets are gapless, sequences full or of a power-of-two length
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    for ps in seqs.values():
        at = 0
        for o, n in sorted(ps):
            assert o == at
            at += n
        assert at <= window and at & (at - 1) == 0
    assert packing.pack(df.limit(0), default_path(), 1).count() == 0


def test_bm25_prefers_the_lexical_neighbour():
    a, b, c = np.array([5, 6, 7, 8]), np.array([5, 6, 7, 9]), np.array([1, 2, 3, 4])
    stats = (np.array([0, 1, 1, 1, 1, 2, 2, 2, 1, 1]), 3, 4.0)
    s = packing.Index([a, b, c], *stats).scores(a)
    assert s[0] > s[1] > s[2] == 0
    done, left = packing.pack_shard([[0, 0, a, 4], [1, 0, c, 4], [2, 0, b, 4]], 8, stats, [])
    assert [p[0] for p in done[0]] == [0, 2] and [p[0] for p in left] == [1]


def test_chat_formatting_leaves_the_shared_tokenizer_alone():
    from oratio.llm import chat_format

    text = "<|endoftext|> in text"
    before = encode(text)
    tok, _ = chat_format._encoder(default_path())
    assert tok.encode(text, add_special_tokens=False).ids != before
    assert encode(text) == before and len(before) == 3
    enc = TextEncoder(default_path())
    assert np.frombuffer(enc([text])[0], enc.dtype).tolist() == before


def test_neighbours_with_other_least_ids_share_a_sequence(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    rows = []
    for p in range(700):  # pairs that share half their words
        shared = rnd.sample(vocab, 8)
        for m in range(2):
            w = shared + rnd.sample(vocab, 8)
            rnd.shuffle(w)
            rows.append((2 * p + m, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one task, so only the shards part the rows
    try:
        pieces = packing.pack(df, default_path(), 1, window=128).select("doc_id", "sequence_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    where = defaultdict(set)
    for r in pieces:
        where[r.doc_id].add(r.sequence_id)
    together = sum(bool(where[2 * p] & where[2 * p + 1]) for p in range(700))
    assert together > 0.5 * 700, together  # others go to windows that were filled before


def test_workers_of_other_operators_drop_the_memo():
    import pyarrow as pa

    from oratio.llm import fm_dedup
    from oratio.llm.common import worker_cache

    class Frame:  # hands out the function that a task would run
        def mapInArrow(self, run, schema):
            return run

    path = default_path()
    words = pa.RecordBatch.from_arrays([pa.array([[1, 2]], pa.list_(pa.int64())), pa.array([1]), pa.array([2])], names=["w", "id", "th"])
    for task in (lambda: list(fm_dedup._anchor_rows(Frame(), 13)(iter([words]))), lambda: list(fm_dedup._first_rows(Frame(), 13)(iter([])))):
        enc = TextEncoder(path)
        want = enc(["some words, kept by a worker"])
        held = len(worker_cache("memo " + path))
        assert held > 3
        task()
        assert not worker_cache("memo " + path) and not worker_cache("tokenizers")
        assert TextEncoder(path)(["some words, kept by a worker"]) == want
