"""The pipeline's stages chained on the smallest table, each checked in plain Python against its input."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from oratio.llm import quality_rules
from oratio.llm.common import cut_lineage
from oratio.llm.tokens import default_path, load_tokenizer

from test_filters_and_groups import brute_components, brute_fingerprint, brute_stats
from test_fm_dedup import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    good = {r.doc_id for r in out["quality_rules"]}
    for r in raw:
        s = brute_stats(r.text)
        if s[0] < 50 or 100 * s[4] > 50 * s[0]:
            assert r.doc_id not in good
    assert len(good) > 0.7 * sum(len((r.text or "").split()) >= 50 for r in raw)
    assert {x.name for x in quality_rules.RULES} >= {"length", "symbols", "stop_words", "repeated_lines"}
    comps = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in out["quality_rules"]])
    assert sorted(r.doc_id for r in out["simhash_dedup"]) == sorted(set(comps.values()))
    want = brute([(r.doc_id, r.text) for r in out["simhash_dedup"]])
    after = {r.doc_id: r for r in out["substring_dedup"]}
    for r in out["simhash_dedup"]:
        n, gone, kept = want[r.doc_id, r.text]
        assert after[r.doc_id].text == (kept if gone else r.text) and after[r.doc_id].n_chars == len(after[r.doc_id].text)
    times = defaultdict(int)
    for r in out["mixing"]:
        times[r.doc_id] += 1
    assert set(times) <= set(after) and max(times.values()) <= 3
    tok = load_tokenizer(default_path())
    taken, need = defaultdict(int), {}
    for r in out["mixing"]:
        need[r.doc_id] = len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    for p in out["packing"]:
        taken[p.doc_id] += p.length
    assert taken == {d: n * times[d] for d, n in need.items()}
    lengths = defaultdict(int)
    for p in out["packing"]:
        lengths[p.sequence_id] += p.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in lengths.values())
    assert np.mean([n == 2048 for n in lengths.values()]) > 0.3
