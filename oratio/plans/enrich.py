"""Full enrichment (Z1): speeches in, the 31-column table out.

Shape of the plan: scan -> pre-filter -> dedup (one shuffle, partial aggregation) -> link
removal -> profile join (AQE picks the form from measured bytes) -> response join
(hash + text key; AQE splits hot keys) -> row-local analysis (lexicons, propaganda search,
keywords, narrative, readability, persuasion, tone; no further shuffle) -> model columns
(Arrow batches, only when scorers are given).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import TOXICITY
from ..operators import clean, keywords as K, lexicon as L, propaganda as P, stats as S
from ..operators.profiles import PROFILE_FIELDS, add_profiles, pick_page, profiles_of_pages, search_hits
from ..operators.responses import FIELDS as RESPONSE_FIELDS, add_responses, latest_responses, responses_from_documents
from ..session import cut_lineage
from ..sources.tables import speeches_raw

# Output columns in write order, with the display names used by the CSV sink.
OUTPUT = [
    ("surname", "Surname"), ("code", "Code"), ("speech", "Speech"),
    ("full_name", "Full name"), ("birthday", "Birthday"), ("birth_place", "Birth place"),
    ("death_day", "Death day"), ("death_place", "Death place"), ("party", "Political party"),
    ("speech_date", "Speech Date"), ("speech_location", "Speech location"), ("speech_occasion", "Speech occasion"),
    ("topic", "Topic"), ("cognitive_bias", "Cognitive Bias"), ("summary", "Summary"), ("keywords", "Keywords"),
    ("underlying_narrative", "Underlying narrative"),
    ("toxicity_text_count", "Toxicity text count"), ("propaganda_type", "Type of propaganda"), ("offsets", "Offsets"),
    ("sentiment", "Sentiment"), ("emotion", "Emotion"), ("persuasion_score", "Persuasion score"),
    ("tf_idf", "TF-IDF"), ("narrative_structure", "Narrative structure"), ("tone", "Tone"),
    ("flesch_reading_ease", "Flesch Reading Ease"), ("flesch_kincaid_grade", "Flesch Kincaid Grade"),
    ("gunning_fog", "Gunning Fog"), ("smog_index", "Smog Index"), ("text_standard", "Text Standard"),
]
OUTPUT_COLUMNS = [c for c, _ in OUTPUT]


def analyse(df: DataFrame, tone_lexicon=None, propaganda=None) -> DataFrame:
    """Row-local analysis columns (phases 3 and 4 without the model scorers): one projection
    computes each bundle once, a second one renders the output columns from the bundles. With
    ``propaganda`` (a flag function of ``operators.propaganda``) the search is gated by that
    classifier or the lexicon (M4), which regroups findings per speech id."""
    tone = (L.tone(T.sql_terms("speech"), tone_lexicon)[1] if tone_lexicon is not None
            else F.lit(None).cast("string"))
    if propaganda is not None:
        base = df.columns
        df = P.propaganda_search_scored(cut_lineage(df), propaganda).select(
            *base, F.struct("propaganda_type", "offsets").alias("__prop"))
        prop = F.col("__prop")
    else:
        prop = P.report_col("speech", "code").alias("__prop")
    keep = [c for c in df.columns if c != "__prop"]
    bundles = df.select(
        *keep,
        L.hits_text("lower(speech)", TOXICITY).alias("toxicity_text_count"),
        prop,
        S.persuasion_col("speech").alias("__pers"),
        K.term_weights_col("speech").alias("__tw"),
        S.narrative_col("speech").alias("__narr"),
        S.counters_col("speech").alias("__cnt"),
        tone.alias("tone"))
    read = S.readability("__cnt")
    return bundles.select(
        *keep, "toxicity_text_count",
        F.col("__prop.propaganda_type").alias("propaganda_type"), F.col("__prop.offsets").alias("offsets"),
        S.persuasion_text("__pers.scores").alias("persuasion_score"),
        K.keyword_text("__tw").alias("tf_idf"),
        S.narrative_text("__narr").alias("narrative_structure"),
        "tone",
        *[read[f].alias(f) for f in ("flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog",
                                     "smog_index", "text_standard")])


def enrich(speeches: DataFrame, profiles: DataFrame | None = None, responses: DataFrame | None = None,
           sentiment=None, emotion=None, tone_lexicon=None, keep_id: bool = True,
           pages: DataFrame | None = None, propaganda=None) -> DataFrame:
    """Z1. ``speeches``: (speech_id, surname, code, speech). ``profiles``: one row per surname
    with the six profile fields; or ``pages``: (surname, rank, title, first_sentence, html), from
    which J2 and X3 make the profiles. ``responses``: (speech, response, seq). ``sentiment`` /
    ``emotion``: M1 scorers (see ``operators.models``). ``propaganda``: a flag function
    (``scorer_flag`` or ``model_flag``) that gates the propaganda search. Missing inputs give null/N/A columns."""
    if profiles is not None and pages is not None:
        raise ValueError("give profiles or pages, not both")
    df = clean.clean_speeches(speeches)
    if pages is not None:
        profiles = profiles_of_pages(pages)
    if profiles is not None:
        df = add_profiles(df, profiles.select("surname", *PROFILE_FIELDS))
    else:
        for f in PROFILE_FIELDS:
            df = df.withColumn(f, F.lit(None).cast("string"))
    if responses is not None:
        df = add_responses(df, latest_responses(responses))
    else:
        for f in RESPONSE_FIELDS:
            df = df.withColumn(f, F.lit("N/A"))
    df = analyse(df, tone_lexicon, propaganda)
    if sentiment is not None:
        df = sentiment.add(df, "speech", "sentiment")
    else:
        df = df.withColumn("sentiment", F.lit(None).cast("string"))
    if emotion is not None:
        df = emotion.add(df, "speech", "emotion")
    else:
        df = df.withColumn("emotion", F.lit(None).cast("string"))
    cols = (["speech_id"] if keep_id else []) + OUTPUT_COLUMNS
    return df.select(*cols)


def testdata_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles over the driver tables: the chosen search hit's title as the full name; the
    driver pages carry no infobox, so the other fields are ``N/A`` / null as X3 would give."""
    hit = pick_page(search_hits(spark, sf_dir))
    return hit.select("surname", F.col("title").alias("full_name"), F.lit("N/A").alias("birthday"),
                      F.lit("N/A").alias("birth_place"), F.lit(None).cast("string").alias("death_day"),
                      F.lit(None).cast("string").alias("death_place"), F.lit("N/A").alias("party"))


def enrich_testdata(spark: SparkSession, sf_dir: str, tone_lexicon=None) -> DataFrame:
    """Z1 over the driver tables (speech view of ``sources.tables``)."""
    return enrich(speeches_raw(spark, sf_dir), testdata_profiles(spark, sf_dir),
                  responses_from_documents(spark, sf_dir), tone_lexicon=tone_lexicon)
