"""Statistics (A1-A11) and keywords (K1-K5): fixtures c23-c27, c31 and properties."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from oratio.operators import keywords as K
from oratio.operators import stats as S


def df1(spark, s):
    return spark.createDataFrame([(1, s)], "speech_id long, speech string")


def test_narrative(spark):  # c23, A2
    r = S.add_narrative(df1(spark, "One two. Three four five six.")).select(
        "narrative", S.narrative_text("narrative").alias("txt")).first()
    n = r.narrative
    assert (n.avg_sentence_length, n.sentence_length_std, n.total_sentences, n.complexity) == (3.0, 1.0, 2, 1.5)
    assert r.txt == ("Average Sentence Length: 3.000\nSentence Length Variation: 1.000\n"
                     "Total Sentences: 2\nComplexity Score: 1.500")


def test_persuasion_fixture(spark):  # c26
    p = S.add_persuasion(df1(spark, "The best leaders act now. Why wait?")).first().persuasion
    c = p.counts
    assert (c.total_tokens, c.superlatives, c.rhetorical_questions, c.emotional_words, c.urgency_words,
            c.authority_words, c.social_proof_words) == (9, 1, 1, 1, 1, 1, 0)
    assert p.scores.total_score == 1.089


def test_persuasion_empty(spark):  # c27
    p = S.add_persuasion(df1(spark, "")).first().persuasion
    assert all(v == 0.0 for v in p.scores.asDict().values())


def test_readability(spark):  # c31 and formulas
    r = S.add_counters(df1(spark, "The cat sat. The dog ran.")).select(
        "counters", S.readability("counters").alias("r")).first()
    again = df1(spark, "The cat sat. The dog ran.").select(S.readability(S.counters_col("speech")).alias("r")).first()
    assert again.r == r.r
    c, rd = r.counters, r.r
    assert (c.words, c.sentences, c.syllables, c.characters, c.polysyllables) == (6, 2, 6, 18, 0)
    assert rd.smog_index == 0.0
    assert math.isclose(rd.flesch_reading_ease, 206.835 - 1.015 * 3 - 84.6 * 1)
    assert rd.text_standard.endswith("grade")


def test_syllable_rule(spark):
    words = ["apple", "table", "make", "the", "rhythm", "area", "lee", "stone", "123"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(S.syllables(F.col("w"))).collect()]
    assert got == [2, 2, 1, 1, 1, 2, 1, 1, 1]


def test_syllables_of_array_equal_single_words(spark):
    words = ["apple", "table", "make", "the", "rhythm", "area", "lee", "stone", "123", "ée", "aile", "le", "e", "ale", "Été",
             "LE", "beautiful", "ye", "be", "naïve", "ΣΑΣ", "x2e"]
    df = spark.createDataFrame([(words,), ([],)], "w array<string>")
    rows = df.select(S.syllables_of(F.col("w")).alias("a"), F.transform("w", S.syllables).alias("b")).collect()
    assert rows[0].a == rows[0].b and rows[1].a == []


def test_keywords_fixture(spark):  # c24
    w = K.add_term_weights(df1(spark, "apple apple banana"))
    r = w.select(K.keyword_text("term_weights")).first()[0]
    assert r == "Apple: 0.894\nBanana: 0.447"


def test_keywords_ties_alphabetical(spark):  # c25
    w = K.add_term_weights(df1(spark, "zeta alpha delta beta gamma epsilon"))
    top = w.select(K.top_terms(F.col("term_weights"))).first()[0]
    assert [t.term for t in top] == ["alpha", "beta", "delta", "epsilon", "gamma"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["apple", "pear", "plum", "kiwi", "the", "and", "fig"]), max_size=40))
def test_term_weights_unit_norm(spark, toks):
    tw = K.add_term_weights(df1(spark, " ".join(toks))).first().term_weights
    expected = {}
    for t in toks:
        if t not in ("the", "and"):
            expected[t] = expected.get(t, 0) + 1
    assert {x.term: x.cnt for x in tw} == expected
    if tw:
        assert math.isclose(sum(x.weight ** 2 for x in tw), 1.0)


def test_corpus_keywords(spark):
    df = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry date")],
                               "speech_id long, speech string")
    out = {(r.speech_id, r.term): r for r in K.corpus_keywords(df).collect()}
    idf = {"apple": math.log(4 / 2) + 1, "banana": math.log(4 / 3) + 1}
    v = [2 * idf["apple"], 1 * idf["banana"]]
    norm = math.sqrt(sum(x * x for x in v))
    assert math.isclose(out[(1, "apple")].weight, v[0] / norm)
    assert out[(1, "apple")].rank == 1


def test_topics_shape(spark):
    rows = [(i, ("apple banana cherry " if i % 2 else "engine wheel brake ") * 5) for i in range(12)]
    df = spark.createDataFrame(rows, "speech_id long, speech string")
    out = K.topics(df, k=2, max_iter=5).collect()
    assert len(out) == 12 and all(0 <= r.topic < 2 and r.topic_terms for r in out)


def test_summary_sentences(spark):  # K6
    text = ("Apples are red. Apples and pears grow. " + "Filler words here again. " * 3)
    df = spark.createDataFrame([(1, text)], "speech_id long, speech string")
    out = K.summary_sentences(df, max_words=8).orderBy("rank").collect()
    assert [r.sentence for r in out][:1] == ["Apples are red."] or out[0].score >= out[-1].score
    assert sum(r.n_words for r in out) <= 8


def test_summary_ranks_by_corpus_weights(spark):  # K6: a word of all speeches weighs little, however often one speech says it
    rows = [(1, "Budget talk budget. Zebra sighting."), *[(i, "Budget talk.") for i in range(2, 40)]]
    df = spark.createDataFrame(rows, "speech_id long, speech string")
    got = {(r.speech_id, r.rank): r.sentence for r in K.summary_sentences(df).collect()}
    assert got[1, 1] == "Zebra sighting." and got[1, 2] == "Budget talk budget."
    own = {x.term: x.weight for x in K.add_term_weights(df.where("speech_id = 1")).first().term_weights}
    assert (2 * own["budget"] + own["talk"]) / 3 > (own["zebra"] + own["sighting"]) / 2  # the other way round by K1


def test_summary_word_budget_and_wordless_speeches(spark):
    rows = [(1, "Alpha beta. Gamma delta epsilon. Zeta."), (2, "the and of"), (3, "")]
    df = spark.createDataFrame(rows, "speech_id long, speech string").withColumn("term", F.lit(1))
    out = K.summary_sentences(df, max_words=3).collect()
    assert sum(r.n_words for r in out if r.speech_id == 1) <= 3
    assert [(r.score, r.sentence) for r in out if r.speech_id == 2] == [(None, "the and of")]
    assert not [r for r in out if r.speech_id == 3]
