"""Lexicons (L1-L3, L6, L7), windows (G1) and the propaganda search (P1-P7):
fixtures c11-c16, c18-c22, c28, c29 and properties."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from oratio.functions import text as T
from oratio.functions.lexicons import PERSUASION, PROPAGANDA, TOXICITY
from oratio.operators import lexicon as L
from oratio.operators import propaganda as P
from oratio.operators.windows import windows_col


def tox(spark, s):
    df = spark.createDataFrame([(s,)], "speech string")
    return L.score_lexicon(df, TOXICITY, "speech", "tox").first()


def test_toxicity_fixture(spark):  # c11
    r = tox(spark, "War is an unprecedented threat")
    assert [(h.category, h.hits) for h in r.tox_hits] == [
        ("violent_language", 1), ("exaggerations", 1), ("fear_appeals", 1)]
    assert r.tox_type == "violent_language"
    assert r.tox_text == "Violent Language: 1\nExaggerations: 1\nFear Appeals: 1"


def test_substring_and_presence(spark):  # c12, c13
    assert [(h.category, h.hits) for h in tox(spark, "The stewards met.").tox_hits] == [("violent_language", 1)]
    assert [(h.category, h.hits) for h in tox(spark, "war war war").tox_hits] == [("violent_language", 1)]
    assert tox(spark, "nothing").tox_hits is None and tox(spark, "nothing").tox_text == ""


def test_curly_apostrophe(spark):  # c14
    df = spark.createDataFrame([("Don’t forget",)], "speech string")
    assert L.score_lexicon(df, PROPAGANDA, "speech", "p").first().p_hits is None


def test_token_lexicon_counts(spark):  # c28
    df = spark.createDataFrame([("don't miss limited time now now",)], "speech string")
    r = df.select(*L.token_lexicon_counts(T.sql_ptokens("speech"), PERSUASION)).first()
    assert list(r) == [0, 2, 0, 0]


def test_tone(spark):  # c29
    df = spark.createDataFrame([("good bad",), ("good",), ("none",)], "speech string")
    subj, label = L.tone(T.sql_terms("speech"), [("good", 0.6), ("bad", 0.2)])
    got = [(round(r[0], 6), r[1]) for r in df.select(subj, label).collect()]
    assert got == [(0.4, "Formal"), (0.6, "Informal"), (0.0, "Formal")]


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 1), (384, 1), (385, 2), (500, 2), (1000, 3)])
def test_window_counts(spark, n, expected):  # c15
    text = " ".join(f"w{i}" for i in range(1, n + 1))
    wins = spark.createDataFrame([(text,)], "t string").select(windows_col("t")).first()[0]
    assert len(wins) == expected
    if n == 1000:
        assert [(w.split()[0], w.split()[-1]) for w in wins] == [("w1", "w512"), ("w385", "w896"), ("w769", "w1000")]


def test_window_rejects_overlap(spark):  # c16
    with pytest.raises(ValueError):
        windows_col("t", 10, 10)


@settings(max_examples=15, deadline=None)
@given(st.integers(min_value=0, max_value=60), st.integers(min_value=2, max_value=12), st.data())
def test_windows_cover_every_word(spark, n, size, data):
    overlap = data.draw(st.integers(min_value=0, max_value=size - 1))
    words = [f"t{i}" for i in range(n)]
    wins = spark.createDataFrame([(" ".join(words),)], "t string").select(windows_col("t", size, overlap)).first()[0]
    covered = [w for win in wins for w in win.split()]
    assert set(covered) == set(words)


def search(spark, rows, lexicon=PROPAGANDA):
    df = spark.createDataFrame(rows, "speech_id long, code int, speech string")
    return {r.speech_id: r for r in P.propaganda_search(df, lexicon).collect()}


def test_report_fixture(spark):  # c18, c19, c20
    out = search(spark, [(1, 1, "They are corrupt. You are a threat."), (2, 1, "They  are corrupt. You are a threat."),
                         (3, 0, "They are corrupt."), (4, 1, "Nothing to see.")])
    assert out[1].propaganda_type == "Opposition distortion\nFear appeals"
    assert out[1].offsets == "Opposition distortion: [0:17]\nFear appeals: [18:35]"
    assert out[2].offsets == "Opposition distortion: \nFear appeals: [19:36]"
    assert (out[3].propaganda_type, out[3].offsets) == ("Not propaganda", None)
    assert (out[4].propaganda_type, out[4].offsets) == ("Not identified", None)


def test_top5_ties_by_first_appearance(spark):  # c21
    lex = [(c, [c]) for c in ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot"]]
    text = "alpha one. bravo two. charlie three. delta four. echo five. foxtrot six. bravo again."
    r = search(spark, [(1, 1, text)], lex)[1]
    assert r.propaganda_type.split("\n") == ["Bravo", "Alpha", "Charlie", "Delta", "Echo"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["They are corrupt.", "A threat!", "Calm words.", "our nation?", "x"]),
                min_size=1, max_size=12))
def test_offsets_slice_back_to_sentences(spark, parts):
    speech = " ".join(parts)
    r = search(spark, [(1, 1, speech)])[1]
    for t in r.top_spans:
        for sp in t.spans:
            if sp.start >= 0:
                found = speech[sp.start:sp.end]
                assert any(found == f.sentence for f in r.findings)


def test_hits_never_exceed_phrases(spark):
    text = " ".join(p for _, ps in TOXICITY for p in ps) * 2
    r = tox(spark, text)
    sizes = dict((c, len(ps)) for c, ps in TOXICITY)
    assert all(h.hits == sizes[h.category] for h in r.tox_hits)


def test_model_gate_unspecified(spark):  # c22
    import numpy as np
    from oratio.operators.models import Scorer

    def load():
        return lambda texts: np.array([[0.0, 1.0] if "vote" in t.lower() else [1.0, 0.0] for t in texts])

    scorer = Scorer(load, ["none", "propaganda"])
    df = spark.createDataFrame([(1, 1, "Calm words. Vote for us. They are corrupt."), (2, 0, "Vote now."),
                                (3, 1, "Nothing here.")], "speech_id long, code int, speech string")
    out = {r.speech_id: r for r in P.propaganda_search_scored(df, P.scorer_flag(scorer)).collect()}
    # one finding each; the model-only sentence comes first
    assert out[1].propaganda_type == "Unspecified\nOpposition distortion"
    assert out[1].offsets == "Unspecified: [12:24]\nOpposition distortion: [25:42]"
    assert out[2].propaganda_type == "Not propaganda" and out[3].propaganda_type == "Not identified"


def test_model_is_asked_once_per_distinct_text(spark, tmp_path):  # M4
    import numpy as np
    from oratio.operators.models import Scorer

    log = str(tmp_path / "asked")  # local workers append what they are asked, one line a text

    def load():
        def score(texts):
            with open(log, "a") as f:
                f.writelines(repr(t) + "\n" for t in texts)
            return np.array([[0.0, 1.0] if "vote" in t.lower() else [1.0, 0.0] for t in texts])
        return score

    same = "Calm words here. Vote for us. Nothing more. "
    long = " ".join(f"Sentence {i % 50} says vote. They are corrupt." if i % 7 == 0 else f"Plain words {i % 60} follow." for i in range(300))
    rows = [(1, 1, same), (2, 1, same), (3, 1, same * 2), (4, 1, long), (5, 1, long), (6, 0, "Vote, code zero."), (7, 1, "")]
    df = spark.createDataFrame(rows, "speech_id long, code int, speech string").repartition(4)
    out = P.propaganda_search_scored(df, P.scorer_flag(Scorer(load, ["none", "propaganda"])))
    got = {r.speech_id: r for r in out.collect()}
    out.count()  # a second action does not ask again
    asked = open(log).read().splitlines()
    assert len(asked) == len(set(asked)) and not any("code zero" in a or a == repr("They are corrupt.") for a in asked)
    assert got[1].propaganda_type == "Unspecified" and got[1].offsets == got[2].offsets == "Unspecified: [17:29]"
    assert got[4].findings == got[5].findings and {f.type for f in got[4].findings} == {"opposition_distortion", "Unspecified"}
    assert got[6].propaganda_type == "Not propaganda" and got[7].propaganda_type == "Not identified"


def test_lexicon_tables_equal_the_literal_forms(spark):  # L6, L7
    texts = ["good bad good fine now", "bad most leaders now now", "nothing", "", None, "good " * 500 + "bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, speech string").withColumn("n", F.lit(1)).withColumn("token", F.lit("x"))
    words = [("good", 0.6), ("bad", 0.2), ("fine", 0.9), ("bad", 0.4)]
    subj, label = L.tone(T.sql_terms("speech"), words)
    want = {r.id: (round(r.s or 0.0, 9), r.t or "Informal") for r in df.select("id", subj.alias("s"), label.alias("t")).collect()}
    table = spark.createDataFrame([*words, ("good", 0.6), (None, 0.1), ("fine", None)], "word string, weight double")
    got = {r.id: (round(r.subjectivity, 9), r.tone) for r in L.tone_table(df, table, "id", T.sql_terms("speech")).collect()}
    assert {i: got[i] for i in got if texts[i]} == {i: want[i] for i in want if texts[i]}
    assert got[3] == got[4] == (0.0, "Formal") and len(got) == len(texts)

    rows = [(c, w) for c, ws in PERSUASION for w in ws]
    table = spark.createDataFrame([*rows, *rows[:3], ("urgency", None)], "category string, word string")
    counts = df.select("id", *[c.alias(n) for (n, _), c in zip(PERSUASION, L.token_lexicon_counts(T.sql_ptokens("speech"), PERSUASION))])
    want = {(r.id, n, r[n]) for r in counts.collect() for n, _ in PERSUASION if r[n] and r[n] > 0}
    got = {tuple(r) for r in L.token_lexicon_table(df, table, "id", T.sql_ptokens("speech")).select("id", "category", "n").collect()}
    assert got == want and got
    assert L.tone_table(df.limit(0), table.selectExpr("word", "1.0 AS weight"), "id", T.sql_terms("speech")).count() == 0


def test_offsets_of_a_long_speech_with_every_sentence_flagged(spark):  # P6
    import time

    parts = [f"They are corrupt in town {i % 900}." if i % 3 else "They are corrupt." for i in range(4500)]
    speech = " ".join(parts).replace("town 7.", "town  7.") + " corrupt."
    assert len(speech.split()) > 20000
    t = time.time()
    r = search(spark, [(1, 1, speech)])[1]
    spans = [(f.sentence, sp.start, sp.end) for t in r.top_spans for f, sp in zip([f for f in r.findings if f.type == t.type], t.spans)]
    assert len(spans) == len(r.findings) > 4000 and time.time() - t < 60
    for sentence, start, end in spans:
        assert start == speech.find(sentence) and end == start + len(sentence)


@pytest.mark.parametrize("name", ["propaganda_offsets", "propaganda_type_counts", "propaganda_findings_probe"])
def test_the_search_is_written_once_in_the_plan(spark, sf_dir, name):  # P1-P6
    from oratio.plans import catalog

    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # every copy of the search splits the windows into sentences once more
    assert plan.count("flatten(") == 1


def test_rows_of_leaves_out_rows_without_elements(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, array(struct('a' AS type, 2 AS n), struct('b' AS type, 3 AS n))), "
                   "(2L, CAST(array() AS array<struct<type:string,n:int>>)), (3L, null) AS t(id, xs)")
    assert sorted(map(tuple, P.rows_of(df, ["id"], "xs").collect())) == [(1, "a", 2), (1, "b", 3)]
