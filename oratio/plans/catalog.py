"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver
tables. Column names and types match the SQL forms in ``oracle.py``; doubles are rounded to
6 places so both engines print the same values. Lists are exploded to rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import PROBE, PROBE_TONE, PROPAGANDA, TOXICITY, PERSUASION
from ..operators import clean, keywords as K, lexicon as L, propaganda as P, stats as S, windows as G
from ..operators import profiles as J, responses as R, embed as E, nearest as N
from ..session import spread
from ..sources.tables import speeches_raw, table

R6 = 6
# Text spliced into documents for the link-removal check: two links, one followed by U+00A0.
LINK_INSERT = " see http://example.org/a?b=1\u00a0tail www.example.com/x end "


def _r(c, n=R6):
    return F.round(c, n)


# ---- views ---------------------------------------------------------------------------------

def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned speeches: F1 -> F2 -> F3 -> F4."""
    return clean.clean_speeches(speeches_raw(spark, sf_dir))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def docs_with(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns), "doc_id")


def with_links(c):
    """Inject a link and a no-break space so F3 has something to remove (documents hold none)."""
    return F.concat(F.substring(c, 1, 120), F.lit(LINK_INSERT),
                    F.expr("substring(text, 121)"))


# ---- 2.2 cleaning ----------------------------------------------------------------------------

def q_drop_incomplete(spark, d):
    return clean.drop_incomplete(speeches_raw(spark, d)).select(
        "speech_id", "surname", F.col("code").cast("bigint").alias("code"),
        F.length("speech").cast("bigint").alias("n_chars"))


def q_exact_dedup(spark, d):
    """F2 over the complete speeches and a copy of each under a higher id, so every group has copies to drop."""
    base = clean.drop_incomplete(speeches_raw(spark, d))
    copies = base.withColumn("speech_id", F.col("speech_id") + F.lit(1 << 40))
    return clean.drop_exact_duplicates(base.unionByName(copies)).select(
        "speech_id", "surname", F.col("code").cast("bigint").alias("code"),
        F.length("speech").cast("bigint").alias("n_chars"))


def q_remove_links(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", T.remove_links(with_links(F.col("text"))).alias("cleaned")).select(
        "doc_id", "cleaned", F.length("cleaned").cast("bigint").alias("n_chars"))


def q_usable_filter(spark, d):
    return usable(spark, d).select("speech_id", "surname", F.col("code").cast("bigint").alias("code"),
                                   F.length("speech").cast("bigint").alias("n_chars"))


def q_politician_predicate(spark, d):
    return docs(spark, d).select("doc_id", clean.is_politician(T.first_sentence("text"))
                                 .cast("bigint").alias("is_politician"))


def q_distinct_speakers(spark, d):
    return clean.speakers(usable(spark, d))


# ---- 2.3 joins -------------------------------------------------------------------------------

def q_first_qualifying_hit(spark, d):
    return J.pick_page(J.search_hits(spark, d)).select("surname", "page_rank", "title")


def q_profile_join(spark, d):
    prof = J.pick_page(J.search_hits(spark, d)).select("surname", F.col("title").alias("full_name"), "page_rank")
    return J.add_profiles(usable(spark, d), prof).select("speech_id", "surname", "full_name", "page_rank")


def q_response_join(spark, d):
    resp = R.latest_responses(R.responses_from_documents(spark, d))
    out = R.add_responses(usable(spark, d), resp)
    return out.select("speech_id", *R.FIELDS, "fields_found")


def q_parse_responses(spark, d):
    t = table(spark, d, "documents")
    return R.parse_responses(t.withColumnRenamed("text", "response"), "response").select(
        "doc_id", *R.FIELDS, "fields_found")


def example_answer(name, speech):
    """A stand-in for the external model: field texts made of the request."""
    return f"{name}${len(speech)}$first words: {speech[:20]}"


def example_answer_at_first(name, speech):
    """The same service on a bad day: it fails for every third length."""
    if len(speech) % 3 == 0:
        raise RuntimeError("try again")
    return example_answer(name, speech)


def q_extract_responses(spark, d):
    """M7 twice over all documents into one store: the second run asks only what failed in the first."""
    import uuid
    from ..session import ensure_checkpoint_dir
    asked = table(spark, d, "documents").select("doc_id", "source", "text")
    store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/answers-{uuid.uuid4().hex}"
    for answer in (example_answer_at_first, example_answer):
        out = R.extract_missing(asked, store, answer, "source", "text", "doc_id")
    return out.where("error IS NULL").select("name", F.md5("speech").alias("speech_md5"), "response", "seq", "generation")


def q_page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", J.first_tag_text(F.col("html"), "title").alias("title"))


# ---- 2.5 lexicons ----------------------------------------------------------------------------

def q_lexicon_hits(lexicon):
    def q(spark, d):
        return L.hits_long(docs(spark, d), lexicon, "doc_id", "text")
    return q


def q_predominant_category(spark, d):
    return docs(spark, d).select(
        "doc_id",
        L.predominant("lower(text)", TOXICITY).alias("toxicity_type"),
        L.predominant("lower(text)", PROBE).alias("probe_type"))


def q_toxicity_text(spark, d):
    return docs(spark, d).select("doc_id", L.hits_text("lower(text)", TOXICITY).alias("toxicity"))


def q_token_lexicon_counts(spark, d):
    cols = L.token_lexicon_counts(T.sql_ptokens("text"), PERSUASION)
    return docs(spark, d).select("doc_id", *[c.cast("bigint").alias(n) for (n, _), c in zip(PERSUASION, cols)])


def q_tone(spark, d):
    subj, label = L.tone(T.sql_terms("text"), PROBE_TONE)
    return docs(spark, d).select("doc_id", _r(subj).alias("subjectivity"), label.alias("tone"))


# Lexicons made of the corpus' own terms, by the terms' length and letters: category, or weight between 0 and 1.
TERM_CATEGORY = "concat('length_', CAST(length(word) % 9 AS STRING))"
TERM_WEIGHT = "((length(word) * 31 + 7 * (length(word) - length(replace(word, 'a', '')))) % 97) / 96.0D"


def corpus_words(spark, d, least_length):
    """The distinct terms of the documents, of a length and more: thousands of lexicon words."""
    return (docs(spark, d).select(F.explode(T.terms("text")).alias("word")).distinct()
            .where(F.length("word") >= least_length))


def q_token_lexicon_table(spark, d):
    """L6 with a lexicon table of all corpus terms of five letters and more."""
    lexicon = corpus_words(spark, d, 5).select(F.expr(TERM_CATEGORY).alias("category"), "word")
    return L.token_lexicon_table(docs(spark, d), lexicon, "doc_id", T.sql_terms("text"))


def q_tone_table(spark, d):
    """L7 with a lexicon table of all corpus terms of six letters and more, some ninety weights."""
    lexicon = corpus_words(spark, d, 6).select("word", F.expr(TERM_WEIGHT).alias("weight"))
    t = L.tone_table(docs(spark, d), lexicon, "doc_id", T.sql_terms("text"), threshold=0.47)
    return t.select("doc_id", _r(F.col("subjectivity")).alias("subjectivity"), "tone")


# ---- 2.6 generators --------------------------------------------------------------------------

def q_sliding_windows(spark, d):
    return G.sliding_windows(docs(spark, d), "doc_id", "text").select(
        "doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"),
        F.size(T.words("chunk")).cast("bigint").alias("n_words"), "chunk")


def q_sentences(spark, d):
    return G.sentence_rows(docs(spark, d), "doc_id", "text").select(
        "doc_id", F.col("sent_no").cast("bigint").alias("sent_no"), "sentence")


def q_token_counts(spark, d):
    return docs(spark, d).select(
        "doc_id", F.size(T.words("text")).cast("bigint").alias("n_words"),
        F.size(T.terms("text")).cast("bigint").alias("n_terms"),
        F.size(T.sentences("text")).cast("bigint").alias("n_sentences"))


def q_token_rows(spark, d):
    return G.token_rows(docs(spark, d), "doc_id", "text").select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


# ---- 2.7 propaganda --------------------------------------------------------------------------

def _search(spark, d, lexicon, routed):
    return P.propaganda_search(usable(spark, d), lexicon, code="code" if routed else None)


def q_findings(lexicon, routed):
    def q(spark, d):
        return P.rows_of(_search(spark, d, lexicon, routed), ["speech_id"], "findings").select(
            "speech_id", F.col("chunk_no").cast("bigint").alias("chunk_no"),
            F.col("sent_no").cast("bigint").alias("sent_no"), "type", "sentence")
    return q


def q_type_counts(spark, d):
    return P.rows_of(_search(spark, d, PROBE, False), ["speech_id"], "type_counts").select(
        "speech_id", "type", (-F.col("neg_n")).cast("bigint").alias("n"),
        F.col("first_seen").cast("bigint").alias("first_seen"))


def q_top_types(spark, d):
    return _search(spark, d, PROBE, False).select(
        "speech_id", F.posexplode(P.top_types_col(F.col("type_counts"))).alias("pos", "t")).select(
        "speech_id", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("t.type").alias("type"),
        (-F.col("t.neg_n")).cast("bigint").alias("n"))


def q_offsets(spark, d):
    return (P.rows_of(_search(spark, d, PROBE, False), ["speech_id"], "top_spans")
            .select("speech_id", "type", F.inline("spans"))
            .select("speech_id", "type", F.col("chunk_no").cast("bigint").alias("chunk_no"),
                    F.col("sent_no").cast("bigint").alias("sent_no"),
                    F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")))


def q_report(lexicon):
    def q(spark, d):
        return _search(spark, d, lexicon, True).select("speech_id", "propaganda_type", "offsets")
    return q


# ---- 2.8 statistics --------------------------------------------------------------------------

def q_narrative_structure(spark, d):
    n = F.col("narrative")
    return S.add_narrative(usable(spark, d)).select(
        "speech_id", _r(n["avg_sentence_length"]).alias("avg_sentence_length"),
        _r(n["sentence_length_std"]).alias("sentence_length_std"),
        n["total_sentences"].alias("total_sentences"), _r(n["complexity"]).alias("complexity"))


def q_narrative_text(spark, d):
    return S.add_narrative(usable(spark, d)).select("speech_id", S.narrative_text("narrative").alias("narrative_text"))


def q_text_counters(spark, d):
    return S.add_counters(usable(spark, d)).select("speech_id", "counters.*")


def q_readability(spark, d):
    r = S.readability("counters")
    return S.add_counters(usable(spark, d)).select(
        "speech_id", _r(r["flesch_reading_ease"]).alias("flesch_reading_ease"),
        _r(r["flesch_kincaid_grade"]).alias("flesch_kincaid_grade"), _r(r["gunning_fog"]).alias("gunning_fog"),
        _r(r["smog_index"]).alias("smog_index"), r["text_standard"].alias("text_standard"))


def q_persuasion_counts(spark, d):
    return S.add_persuasion(usable(spark, d)).select("speech_id", "persuasion.counts.*")


def q_persuasion_score(spark, d):
    p = S.add_persuasion(usable(spark, d))
    names = [f.name for f in p.schema["persuasion"].dataType["scores"].dataType.fields]
    return p.select("speech_id", *[_r(F.col(f"persuasion.scores.{n}")).alias(n) for n in names])


def q_persuasion_text(spark, d):
    return S.add_persuasion(usable(spark, d)).select("speech_id", S.persuasion_text("persuasion.scores")
                                                     .alias("persuasion_text"))


def q_per_speaker(spark, d):
    p = S.add_persuasion(S.add_counters(usable(spark, d)))
    r = S.readability("counters")
    out = S.per_speaker(p, {"avg_total_score": F.col("persuasion.scores.total_score"),
                            "avg_flesch_reading_ease": r["flesch_reading_ease"],
                            "avg_words": F.col("counters.words")})
    return out.select("surname", "speeches", *[_r(F.col(c)).alias(c) for c in
                                               ("avg_total_score", "avg_flesch_reading_ease", "avg_words")])


# ---- 2.9 keywords ----------------------------------------------------------------------------

def q_term_weights(spark, d):
    return K.add_term_weights(usable(spark, d)).select("speech_id", F.inline("term_weights")).select(
        "speech_id", "term", "cnt", _r(F.col("weight")).alias("weight"))


def q_top_keywords(spark, d):
    w = K.add_term_weights(usable(spark, d))
    return w.select("speech_id", F.posexplode(K.top_terms(F.col("term_weights"))).alias("pos", "k")).select(
        "speech_id", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("k.term").alias("term"),
        (-F.col("k.neg")).alias("cnt"), _r(F.col("k.weight")).alias("weight"))


def q_keyword_text(spark, d):
    return K.add_term_weights(usable(spark, d)).select("speech_id", K.keyword_text("term_weights").alias("keyword_text"))


def q_corpus_keywords(spark, d):
    return K.corpus_keywords(usable(spark, d)).select("speech_id", "term", "cnt", _r(F.col("weight")).alias("weight"),
                                                      "rank")


# ---- 2.10 embeddings -------------------------------------------------------------------------

def q_mean_pool(spark, d):
    e = table(spark, d, "embeddings")
    pooled = E.pool_embeddings(e.select(F.col("label").cast("bigint").alias("label"), "embedding"), "label",
                               "embedding")
    return pooled.select("label", F.posexplode("embedding").alias("dim", "value")).select(
        "label", F.col("dim").cast("bigint").alias("dim"), _r(F.col("value")).alias("value"))


def with_infobox(pages):
    """The pages under an infobox made of their own ids: every third without a link in its birth place, every second
    with a death row, every fifth without a party."""
    n = F.col("page_id").cast("string")
    born = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Town "), n)).otherwise(
        F.concat(F.lit('<a href="#">Town '), n, F.lit("</a>, Land")))
    died = F.when(F.col("page_id") % 2 == 0, F.concat(
        F.lit('<tr><th>Died</th><td><span>(day '), n, F.lit(')</span><br><a href="#">End '), n, F.lit("</a>, Land</td></tr>"))
    ).otherwise(F.lit(""))
    party = F.when(F.col("page_id") % 5 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<tr><th>Political party</th><td><a href="#">Party '), n, F.lit("</a></td></tr>")))
    return F.concat(F.lit('<div class="nickname">Page '), n,
                    F.lit('</div><table class="infobox vcard"><tr><th>Born</th><td><span class="bday">'), n, F.lit("</span><br>"),
                    born, F.lit("</td></tr>"), died, party, F.lit("</table>"), F.col("html"))


def q_extract_profiles(spark, d):
    pages = table(spark, d, "pages")
    return J.extract_profiles(pages.select(F.col("page_id").cast("string").alias("surname"), with_infobox(pages).alias("html")))


def q_project_2d(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return E.project_2d(e, "vec_id", "embedding")


def q_nearest_vectors(spark, d):
    """E4 over all embeddings: the five nearest others of each."""
    return N.nearest_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", k=5).select(
        "vec_id", F.col("rank").cast("bigint").alias("rank"), "neighbour_id", "similarity")


def q_summary_sentences(spark, d):
    return K.summary_sentences(usable(spark, d)).select(
        "speech_id", "sent_no", "rank", _r(F.col("score")).alias("score"), "n_words", "sentence")


def q_propaganda_report_model(spark, d):
    """M4 + P1-P7: windows and sentences gated by a classifier trained on the speech codes
    (code 1 = propaganda in the speech view) or by the lexicon."""
    from ..operators.models import fit_text_classifier
    from ..session import cut_lineage
    sp = cut_lineage(usable(spark, d))  # training rows, search input and join side
    model = fit_text_classifier(sp, "speech", "code", num_features=1 << 16, max_iter=20)
    out = P.propaganda_search_scored(sp, P.model_flag(model))
    return out.select("speech_id", "propaganda_type", "offsets")


# A rule in a classifier's place whose answers both engines can give.
FLAG_RULE = "length({text}) % 5 = 0"


def q_propaganda_report_flag(spark, d):
    """M4 + P1-P7 with a deterministic flag in the classifier's place: windows and sentences gated by it or the lexicon."""
    from ..session import cut_lineage
    out = P.propaganda_search_scored(cut_lineage(usable(spark, d)), P.sql_flag(FLAG_RULE), PROBE)
    return out.select("speech_id", "propaganda_type", "offsets")


def q_speech_file_roundtrip(spark, d):
    """S2 -> S1 -> F1-F4: the speech view written as the TSV input format into the checkpoint
    folder, read back and cleaned (ids come from file order, so they are left out)."""
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..sources.files import read_speeches, write_speech_file
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/speech-tsv-{uuid.uuid4().hex}"
    write_speech_file(speeches_raw(spark, d), path)
    out = clean.clean_speeches(read_speeches(spark, path))
    return out.select("surname", F.col("code").cast("bigint").alias("code"),
                      F.length("speech").cast("bigint").alias("n_chars"), "speech")


def q_toxic_model(spark, d):
    """M5/M6: classifier trained on the labelled usable speeches, applied to every document."""
    from ..operators.models import add_toxicity_model, fit_text_classifier
    from ..session import cut_lineage
    # iterative fit: read the cleaned training rows from a checkpoint, not the whole lineage
    train = cut_lineage(usable(spark, d).select("speech", "code"))
    model = fit_text_classifier(train, "speech", "code", num_features=1 << 16, max_iter=20)
    out = add_toxicity_model(docs(spark, d).withColumnRenamed("text", "speech"), model, "speech", "toxicity", "p")
    return out.select("doc_id", "toxicity", _r(F.col("p")).alias("p"))


def q_score_text(spark, d):
    """M1-M3: a model of all languages of ``documents``, trained on its rows and applied to every row."""
    from ..operators.models import fit_counts, stored_counts
    counts = stored_counts(docs_with(spark, d, "lang"), "text", by="lang")  # one cut of the texts for fit and scoring
    out = fit_counts(counts, "lang").score_counts(counts, "label", "p")
    return out.select("doc_id", "label", _r(F.col("p")).alias("p"))


def q_topics(spark, d):
    return K.topics(usable(spark, d), k=5)


def q_speech_embeddings(spark, d):
    """E1+E2+F8. Ten places: a mean over few words often ends in a 5 behind the sixth."""
    e = E.speech_embeddings(usable(spark, d), "speech_id", "speech")
    return e.select("speech_id", F.posexplode("embedding").alias("dim", "value")).select(
        "speech_id", F.col("dim").cast("bigint").alias("dim"), _r(F.col("value"), 10).alias("value"))


def q_enrich_values(spark, d):
    """Z1, all 31 columns (readability numbers rounded to 6 places for the comparison)."""
    from .enrich import enrich_testdata
    from ..operators.responses import FIELDS
    e = enrich_testdata(spark, d, tone_lexicon=PROBE_TONE)
    return e.select("speech_id", "surname", F.col("code").cast("bigint").alias("code"), "speech", "full_name",
                    "birthday", "birth_place", "death_day", "death_place", "party", *FIELDS,
                    "toxicity_text_count", "propaganda_type", "offsets", "sentiment", "emotion",
                    "persuasion_score", "tf_idf", "narrative_structure", "tone",
                    *[_r(F.col(c)).alias(c) for c in ("flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog",
                                                       "smog_index")], "text_standard")


def q_enrich(spark, d):
    from .enrich import enrich_testdata
    return enrich_testdata(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "drop_incomplete": q_drop_incomplete,
    "exact_dedup": q_exact_dedup,
    "remove_links": q_remove_links,
    "usable_filter": q_usable_filter,
    "speech_file_roundtrip": q_speech_file_roundtrip,
    "politician_predicate": q_politician_predicate,
    "distinct_speakers": q_distinct_speakers,
    "first_qualifying_hit": q_first_qualifying_hit,
    "profile_join": q_profile_join,
    "response_join": q_response_join,
    "parse_responses": q_parse_responses,
    "page_titles": q_page_titles,
    "extract_responses": q_extract_responses,
    "lexicon_hits_propaganda": q_lexicon_hits(PROPAGANDA),
    "lexicon_hits_toxicity": q_lexicon_hits(TOXICITY),
    "lexicon_hits_probe": q_lexicon_hits(PROBE),
    "predominant_category": q_predominant_category,
    "toxicity_text": q_toxicity_text,
    "token_lexicon_counts": q_token_lexicon_counts,
    "tone": q_tone,
    "token_lexicon_table": q_token_lexicon_table,
    "tone_table": q_tone_table,
    "sliding_windows": q_sliding_windows,
    "sentences": q_sentences,
    "token_counts": q_token_counts,
    "token_rows": q_token_rows,
    "propaganda_findings": q_findings(PROPAGANDA, True),
    "propaganda_findings_probe": q_findings(PROBE, False),
    "propaganda_type_counts": q_type_counts,
    "propaganda_top_types": q_top_types,
    "propaganda_offsets": q_offsets,
    "propaganda_report": q_report(PROPAGANDA),
    "propaganda_report_probe": q_report(PROBE),
    "narrative_structure": q_narrative_structure,
    "narrative_text": q_narrative_text,
    "text_counters": q_text_counters,
    "readability": q_readability,
    "persuasion_counts": q_persuasion_counts,
    "persuasion_score": q_persuasion_score,
    "persuasion_text": q_persuasion_text,
    "per_speaker": q_per_speaker,
    "term_weights": q_term_weights,
    "top_keywords": q_top_keywords,
    "keyword_text": q_keyword_text,
    "corpus_keywords": q_corpus_keywords,
    "summary_sentences": q_summary_sentences,
    "mean_pool": q_mean_pool,
    "extract_profiles": q_extract_profiles,
    "project_2d": q_project_2d,
    "nearest_vectors": q_nearest_vectors,
    "toxic_model": q_toxic_model,
    "propaganda_report_model": q_propaganda_report_model,
    "propaganda_report_flag": q_propaganda_report_flag,
    "score_text": q_score_text,
    "topics": q_topics,
    "speech_embeddings": q_speech_embeddings,
    "enrich": q_enrich,
    "enrich_values": q_enrich_values,
}
