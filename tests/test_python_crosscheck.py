"""Brute-force cross-check: plain-Python versions of the operator semantics, run on the
sf0.001 speeches, compared with the Spark operators row by row."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oratio.functions.lexicons import PERSUASION, PROBE, PROPAGANDA, stop_words
from oratio.operators import clean
from oratio.operators import keywords as K
from oratio.operators import propaganda as P
from oratio.operators import stats as S
from oratio.sources.tables import speeches_raw

SENT = re.compile(r"(?<=[.!?])\s+")
LINK = re.compile(r"http\S+|www\.\S+")


@pytest.fixture(scope="module")
def speeches(spark, sf_dir):
    return clean.clean_speeches(speeches_raw(spark, sf_dir)).cache()


@pytest.fixture(scope="module")
def py_speeches(sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    df = docs.merge(labels, on="doc_id", how="left")
    df = df.rename(columns={"doc_id": "speech_id", "source": "surname", "toxic": "code", "text": "speech"})
    df = df[["speech_id", "surname", "code", "speech"]].dropna()
    df = df.sort_values("speech_id").drop_duplicates(["surname", "code", "speech"], keep="first")
    df["speech"] = df["speech"].map(lambda t: LINK.sub("", t))
    df = df[(df["speech"].str.len() >= 200) & df["code"].isin([0, 1])]
    return {int(r.speech_id): (int(r.code), r.speech) for r in df.itertuples()}


def py_report(speech, lexicon, size=512, overlap=128):
    words = speech.split()
    windows = [" ".join(words[i:i + size]) for i in range(0, len(words), size - overlap)]
    phrases = [p for _, ps in lexicon for p in ps]
    findings = []
    for chunk in windows:
        if not any(p in chunk.lower() for p in phrases):
            continue
        for sentence in SENT.split(chunk):
            hits = [sum(p in sentence.lower() for p in ps) for _, ps in lexicon]
            if max(hits) > 0:
                findings.append((lexicon[hits.index(max(hits))][0], sentence))
    if not findings:
        return "Not identified", None
    top = Counter(t for t, _ in findings).most_common(5)
    names, lines = [], []
    for t, _ in top:
        label = t.replace("_", " ").capitalize()
        spans = [f"[{speech.find(s)}:{speech.find(s) + len(s)}]" for tt, s in findings
                 if tt == t and speech.find(s) != -1]
        names.append(label)
        lines.append(f"{label}: " + ", ".join(spans))
    return "\n".join(names), "\n".join(lines)


def test_usable_view(speeches, py_speeches):
    got = {r.speech_id: (r.code, r.speech) for r in speeches.collect()}
    assert got == py_speeches


@pytest.mark.parametrize("lexicon", [PROPAGANDA, PROBE], ids=["propaganda", "probe"])
def test_propaganda_report(speeches, py_speeches, lexicon):
    got = {r.speech_id: (r.propaganda_type, r.offsets)
           for r in P.propaganda_search(speeches, lexicon).select("speech_id", "propaganda_type", "offsets").collect()}
    for sid, (code, speech) in py_speeches.items():
        want = py_report(speech, lexicon) if code == 1 else ("Not propaganda", None)
        assert got[sid] == want, sid


def test_keywords_and_narrative(speeches, py_speeches):
    stops = set(stop_words())
    rows = K.add_term_weights(S.add_narrative(speeches)).select(
        "speech_id", "narrative", K.top_terms(F.col("term_weights")).alias("top")).collect()
    for r in rows:
        speech = py_speeches[r.speech_id][1]
        terms = [t for t in re.findall(r"(?u)\b\w\w+\b", speech.lower()) if t not in stops]
        cnt = Counter(terms)
        norm = math.sqrt(sum(v * v for v in cnt.values()))
        want = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        assert [(t.term, -t.neg) for t in r.top] == want
        assert all(math.isclose(t.weight, -t.neg / norm) for t in r.top)
        lengths = [len(s.split()) for s in SENT.split(speech) if s]
        n = r.narrative
        assert n.total_sentences == len(lengths)
        assert math.isclose(n.avg_sentence_length, np.mean(lengths))
        assert math.isclose(n.sentence_length_std, np.std(lengths), abs_tol=1e-9)


def test_persuasion(speeches, py_speeches):
    rows = S.add_persuasion(speeches).select("speech_id", "persuasion").collect()
    for r in rows:
        speech = py_speeches[r.speech_id][1]
        tokens = re.findall(r"\w+|[^\w\s]", speech.lower())
        c = r.persuasion.counts
        assert c.total_tokens == len(tokens)
        for (cat, words), got in zip(PERSUASION, (c.emotional_words, c.urgency_words, c.authority_words,
                                                  c.social_proof_words)):
            assert got == sum(t in words for t in tokens), cat
        assert c.rhetorical_questions == sum(s.strip().endswith("?") for s in SENT.split(speech))


def py_summaries(speeches, stops, max_words=100):
    """K6 in plain Python: {id: [(sent_no, rank)]}, sentences by the mean TF-IDF of the whole corpus."""
    def terms(t):
        return [x for x in re.findall(r"(?u)\b\w\w+\b", t.lower()) if x not in stops]

    counts = {i: Counter(terms(s)) for i, s in speeches.items()}
    held = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(speeches)) / (1 + n)) + 1 for t, n in held.items()}
    out = {}
    for i, speech in speeches.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in counts[i].items())) or 1.0
        rows = []
        for j, s in enumerate(s for s in SENT.split(speech) if s):
            ts = terms(s)
            score = sum(counts[i][t] * idf[t] / norm for t in ts) / len(ts) if ts else None
            rows.append((score is None, -round(score, 9) if score is not None else 0.0, j, len(s.split())))
        total, out[i] = 0, []
        for rank, (_, _, j, n) in enumerate(sorted(rows), start=1):
            total += n
            if total > max_words:
                break
            out[i].append((j, rank))
    return out


def test_summary_sentences(speeches, py_speeches):
    got = {}
    for r in K.summary_sentences(speeches).collect():
        got.setdefault(r.speech_id, []).append((r.sent_no, r.rank))
    want = py_summaries({i: s for i, (_, s) in py_speeches.items()}, set(stop_words()))
    for sid in py_speeches:
        assert sorted(got.get(sid, []), key=lambda x: x[1]) == want[sid], sid
