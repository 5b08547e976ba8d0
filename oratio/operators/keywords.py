"""Keywords and term weights (K1-K4, K6).

K1/K2 are fitted on one speech at a time, so their IDF is 1 and each speech's term weights
depend on that speech only: term counting is done inside the row (sort the terms, measure
runs of equal terms), with no explode and no shuffle. K4 is the corpus form and does need
document frequencies: one partial aggregation per term and one join. K6 scores sentences by
the K4 weights of their terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sqlexpr as Q
from ..functions import text as T
from ..functions.lexicons import TOP_KEYWORDS, stop_words
from ..session import cut_lineage


def content_terms(text: str) -> Column:
    """Lower-cased terms of two or more word characters, stop words removed (``text``: column
    name or SQL; the stop-word list becomes a hash-set test)."""
    return F.expr(f"filter({T.sql_terms(text)}, t -> NOT t IN {Q.in_list(stop_words())})")


def term_counts(text) -> Column:
    """``array<struct<term, cnt>>`` sorted by term: counts of each distinct content term."""
    empty = F.array().cast("array<struct<term:string,cnt:bigint>>")

    def runs(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(1), n),
                          lambda i: (i == 1) | (F.element_at(s, i) != F.element_at(s, i - 1)))
        return T.let(starts, lambda st: F.transform(st, lambda p, k: F.struct(
            F.element_at(s, p).alias("term"),
            (F.coalesce(F.try_element_at(st, k + 2), n + 1) - p).cast("bigint").alias("cnt"))))

    return T.let(F.sort_array(content_terms(text)), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty))


def add_term_weights(df: DataFrame, text: str = "speech", out: str = "term_weights") -> DataFrame:
    return df.withColumn(out, term_weights_col(text))


def term_weights_col(text: str = "speech") -> Column:
    """K1: per speech ``array<struct<term, cnt, weight>>``, weight = cnt / sqrt(sum cnt^2)."""
    def weigh(tc):
        norm = F.sqrt(F.aggregate(tc, F.lit(0.0), lambda acc, x: acc + x["cnt"] * x["cnt"]))
        return T.let(norm, lambda nv: F.transform(tc, lambda x: F.struct(
            x["term"].alias("term"), x["cnt"].alias("cnt"), (x["cnt"] / nv).alias("weight"))))
    return T.let(term_counts(text), weigh)


def top_terms(weights: Column, k: int = TOP_KEYWORDS) -> Column:
    """K2: k terms with the highest weight, ties alphabetical (count order = weight order)."""
    ranked = F.sort_array(F.transform(weights, lambda x: F.struct(
        (-x["cnt"]).alias("neg"), x["term"].alias("term"), x["weight"].alias("weight"))))
    return F.slice(ranked, 1, k)


def keyword_text(weights: str, k: int = TOP_KEYWORDS) -> Column:
    """K3: ``Term: 0.123`` lines for the top k terms; term in Python's title case, weight as
    Python's ``%.3f`` (exact half-even). ``weights``: column path of the K1 array."""
    top = (f"slice(sort_array(transform({weights}, x -> named_struct('neg', -x.cnt, 'term', x.term, "
           f"'weight', x.weight))), 1, {k})")
    line = f"concat({T.python_title_sql('y.term')}, ': ', {T.python_fixed_sql('y.weight', 3)})"
    return F.expr(f"array_join(transform({top}, y -> {line}), '\\n')")


# Shares that each term of the K4 join is dealt over.
SALTS = 16


def corpus_weights(df: DataFrame, id_col: str = "speech_id", text: str = "speech") -> DataFrame:
    """K4 for every term: corpus TF-IDF, idf = ln((1+N)/(1+df)) + 1, L2-normalised per speech; rows
    (id, term, cnt, tfidf, weight).

    Term counts come from the row-local K1 arrays (map side); document frequencies are a
    per-term partial aggregation. The per-speech counts are checkpointed once (they feed the
    document count, the frequencies and the join). A term that most speeches hold is dealt over
    ``SALTS`` partitions of the idf join, whose other side repeats each term that often; the
    document count is a scalar subquery of the plan."""
    local = cut_lineage(df.select(id_col, term_counts(text).alias("__tc")))
    n_docs = local.agg(F.count(F.lit(1)).alias("n")).scalar()
    tc = local.select(id_col, F.inline("__tc"))
    dfreq = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = dfreq.select("term", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1).alias("idf"))
    salted = idf.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    w = (tc.withColumn("__salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
           .join(salted, ["term", "__salt"]).withColumn("tfidf", F.col("cnt") * F.col("idf")))
    by_doc = Window.partitionBy(id_col)
    return (w.withColumn("weight", F.col("tfidf") / F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf")).over(by_doc)))
             .select(id_col, "term", "cnt", "tfidf", "weight"))


def corpus_keywords(df: DataFrame, id_col: str = "speech_id", text: str = "speech",
                    k: int = TOP_KEYWORDS) -> DataFrame:
    """K4: rows (id, term, cnt, weight, rank) for the top k terms per speech by corpus weight."""
    ranked = Window.partitionBy(id_col).orderBy(F.col("tfidf").desc(), F.col("term"))
    return (corpus_weights(df, id_col, text).withColumn("rank", F.row_number().over(ranked))
             .where(F.col("rank") <= k)
             .select(id_col, "term", "cnt", "weight", F.col("rank").cast("bigint").alias("rank")))


def topics(df: DataFrame, id_col: str = "speech_id", text: str = "speech", k: int = 5, buckets: int = 1 << 14,
           top_terms_per_topic: int = 5, max_iter: int = 10, seed: int = 42) -> DataFrame:
    """K5: LDA topic per speech, (id, topic, topic_weight, topic_terms).

    Every term counts: terms are hashed to ``buckets`` (so driver state, the k x buckets model, has
    a fixed size whatever the vocabulary), LDA runs on the bucket counts, and a topic's terms are
    the most frequent term of each of its top buckets, joined from the (term, bucket) table."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array

    def bucket(term):
        return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("string")

    toks = df.select(id_col, content_terms(text).alias("__terms"))
    sc_model = CountVectorizerModel.from_vocabulary([str(i) for i in range(buckets)], inputCol="__b", outputCol="__tf")
    tf = cut_lineage(sc_model.transform(toks.select(id_col, F.transform("__terms", bucket).alias("__b")))
                     .select(id_col, "__tf"))
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online", featuresCol="__tf",
              topicDistributionCol="__dist").fit(tf)
    top = lda.describeTopics(top_terms_per_topic).select(
        F.col("topic").cast("int").alias("topic"), F.posexplode("termIndices").alias("rank", "b"))
    names = (toks.select(F.explode("__terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
             .groupBy(bucket(F.col("term")).cast("int").alias("b"))
             .agg(F.max_by("term", F.struct("n", "term")).alias("term")))
    desc = (top.join(names, "b", "left").groupBy("topic")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))),
                                          lambda x: x["term"]), ", ").alias("topic_terms")))
    dist = lda.transform(tf).select(id_col, vector_to_array("__dist").alias("__d"))
    best = dist.select(id_col, F.array_max("__d").alias("topic_weight"),
                       (F.array_position("__d", F.array_max("__d")) - 1).cast("int").alias("topic"))
    return best.join(desc, "topic", "left").select(id_col, "topic", "topic_weight", "topic_terms")


def placed_terms(text: str) -> Column:
    """``array<struct<h, at>>``: each distinct content term of a text (its 64-bit hash) with the numbers of the sentences it
    occurs in, one entry per occurrence. Built inside the row: a term travels once per text, as a number."""
    sents = f"filter({T.sql_sentences(text)}, s -> s <> '')"
    words = f"filter({T.sql_terms('s')}, t -> NOT t IN {Q.in_list(stop_words())})"
    pairs = f"sort_array(flatten(transform({sents}, (s, j) -> transform({words}, t -> named_struct('t', t, 'j', j)))))"
    starts = "filter(sequence(1, size(p)), i -> i = 1 OR get(p, i - 1).t <> get(p, i - 2).t)"
    placed = ("transform(st, (a, k) -> named_struct('h', xxhash64(get(p, a - 1).t), 'at', "
              "transform(slice(p, a, coalesce(get(st, k + 1), size(p) + 1) - a), x -> x.j)))")
    empty = "CAST(array() AS ARRAY<STRUCT<h: BIGINT, at: ARRAY<INT>>>)"
    return F.expr(T.sql_let(pairs, "p", f"CASE WHEN size(p) > 0 THEN {T.sql_let(starts, 'st', placed)} ELSE {empty} END"))


def sentence_scores(df: DataFrame, id_col: str = "speech_id", text: str = "speech") -> DataFrame:
    """(id, scores) of the speeches with content terms: map from sentence number to the mean corpus weight (K4) of the sentence's
    content terms, each occurrence counted; no entry without content terms.

    One row a (speech, term), holding the term's hash and sentences, joins the term's idf and goes to its speech as
    numbers, where the speech's norm and sentence means come together. The idf table is written first, so its
    measured size decides the join: sent to all tasks below the session's threshold, else shuffled by term, where AQE splits
    the terms that most speeches hold."""
    local = cut_lineage(df.select(id_col, placed_terms(text).alias("__p")))
    n_docs = local.agg(F.count(F.lit(1)).alias("n")).scalar()
    dfreq = local.select(F.explode("__p.h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    idf = cut_lineage(dfreq.select("h", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1).alias("idf")))
    weighed = local.select(id_col, F.inline("__p")).join(idf, "h").select(id_col, "at", (F.size("at") * F.col("idf")).alias("w"))
    per = weighed.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__norm"),
                                      F.collect_list(F.struct("at", "w")).alias("__t"))
    flat = "sort_array(flatten(transform(__t, x -> transform(x.at, j -> named_struct('j', j, 'w', x.w / __norm)))))"
    starts = "filter(sequence(1, size(f)), i -> i = 1 OR get(f, i - 1).j <> get(f, i - 2).j)"
    mean = ("transform(st, (a, k) -> element_at(transform(array(coalesce(get(st, k + 1), size(f) + 1) - a), "
            "n -> aggregate(slice(f, a, n), 0D, (s, x) -> s + x.w) / n), 1))")
    scores = T.sql_let(flat, "f", T.sql_let(starts, "st", f"map_from_arrays(transform(st, a -> get(f, a - 1).j), {mean})"))
    return per.select(id_col, F.expr(scores).alias("scores"))


def summary_sentences(df: DataFrame, id_col: str = "speech_id", text: str = "speech",
                      max_words: int = 100) -> DataFrame:
    """K6: rows (id, sent_no, rank, score, n_words, sentence). Sentences are ranked by the mean corpus weight (K4) of
    their content terms, rounded to 9 places, ties by position, those without content terms last, and taken
    while the running sum of words (a window frame from the first rank on) stays within ``max_words``. The text joins
    its scores by id once; the windows keep that partitioning."""
    speeches = cut_lineage(df.select(id_col, F.col(text).alias("__text")))  # read for the terms and for the sentences
    rows = speeches.join(sentence_scores(speeches, id_col, "__text"), id_col, "left")
    sents = rows.select(id_col, "scores", F.posexplode(T.nonempty_sentences("__text")).alias("sent_no", "sentence"))
    sents = sents.select(id_col, F.col("sent_no").cast("bigint").alias("sent_no"), F.try_element_at("scores", "sent_no").alias("score"),
                         F.size(T.words("sentence")).cast("bigint").alias("n_words"), "sentence")
    order = Window.partitionBy(id_col).orderBy(F.round("score", 9).desc_nulls_last(), F.col("sent_no"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (sents.withColumn("rank", F.row_number().over(order).cast("bigint")).withColumn("__sum", F.sum("n_words").over(upto))
            .where(F.col("__sum") <= max_words).select(id_col, "sent_no", "rank", "score", "n_words", "sentence"))
