"""Lexicon scoring.

All work is per row and JVM-side: a category's hits are a plain sum of ``contains`` terms on
the lower-cased text, computed once per row; no shuffle, no Python. Expressions are generated
as SQL text (``functions.sqlexpr``) and take the lower-cased text as a SQL expression ``lc``
(a column name or a lambda variable field).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as Q


def category_hits(lc: str, lexicon) -> list[Column]:
    """L1 per category: number of distinct phrases present as substrings (presence, not
    occurrences). ``lc`` is SQL for the already lower-cased text."""
    return [F.expr(h) for h in Q.hits(lc, lexicon)]


def predominant(lc: str, lexicon) -> Column:
    """L2: category with the most hits, ties to the earlier category; null when none hit."""
    return F.expr(Q.predominant(Q.hits(lc, lexicon), lexicon))


def hits_array_sql(lc: str, lexicon) -> str:
    items = ", ".join(f"named_struct('category', {Q.lit(c)}, 'hits', {h})" for (c, _), h in zip(lexicon, Q.hits(lc, lexicon)))
    return f"filter(array({items}), x -> x.hits > 0)"


def hits_array(lc: str, lexicon) -> Column:
    """L1 as ``array<struct<category, hits>>`` in lexicon order, zero categories dropped, none -> null."""
    a = hits_array_sql(lc, lexicon)
    return F.expr(f"element_at(transform(array({a}), a -> CASE WHEN size(a) > 0 THEN a END), 1)")


def hits_text(lc: str, lexicon) -> Column:
    """L3: ``Category Name: n`` lines in lexicon order (title case); none -> ''."""
    parts = ", ".join(f"CASE WHEN {h} > 0 THEN concat({Q.lit(Q.title(c) + ': ')}, CAST({h} AS STRING)) END"
                      for (c, _), h in zip(lexicon, Q.hits(lc, lexicon)))
    return F.expr(f"concat_ws('\\n', {parts})")


def score_lexicon(df: DataFrame, lexicon, text: str = "speech", prefix: str = "lex") -> DataFrame:
    """Adds ``{prefix}_hits`` (array), ``{prefix}_type`` (predominant) and ``{prefix}_text``."""
    lc = f"__{prefix}_lc"
    df = df.withColumn(lc, F.lower(F.col(text)))
    return df.select("*", hits_array(lc, lexicon).alias(f"{prefix}_hits"),
                     predominant(lc, lexicon).alias(f"{prefix}_type"),
                     hits_text(lc, lexicon).alias(f"{prefix}_text")).drop(lc)


def hits_long(df: DataFrame, lexicon, id_col: str, text: str) -> DataFrame:
    """L1 as rows (id, category, cat_order, hits) for categories with hits > 0."""
    lc = f"lower({text})"
    items = ", ".join(f"named_struct('cat_order', CAST({i} AS BIGINT), 'category', {Q.lit(c)}, 'hits', CAST({h} AS BIGINT))"
                      for i, ((c, _), h) in enumerate(zip(lexicon, Q.hits(lc, lexicon))))
    arr = F.expr(f"filter(array({items}), x -> x.hits > 0)")
    return df.select(id_col, F.inline(arr)).select(id_col, "category", "cat_order", "hits")


def token_counts_sql(tokens: str, words) -> str:
    return f"size(filter({tokens}, t -> t IN {Q.in_list(words)}))"


def token_lexicon_counts(tokens: str, lexicon) -> list[Column]:
    """Per category the number of tokens equal to a lexicon entry (occurrences).
    Multi-word entries can never equal one token and count 0. ``tokens``: SQL for an array."""
    return [F.expr(token_counts_sql(tokens, words)) for _, words in lexicon]


def weighted_mean(tokens: str, weighted_lexicon) -> Column:
    """Mean lexicon weight over tokens found in the lexicon; 0.0 when none match.

    Entries are grouped by weight, each group a set-membership test (hash set for long
    lists), so the cost per token is the number of distinct weights, not the lexicon size."""
    groups: dict[float, list[str]] = {}
    for w, v in weighted_lexicon:
        groups.setdefault(float(v), []).append(w)
    ordered = sorted(groups.items())
    counts = ", ".join(token_counts_sql("tk", ws) for _, ws in ordered)
    n = " + ".join(f"c[{i}]" for i in range(len(ordered)))
    s = " + ".join(f"c[{i}] * CAST({v!r} AS DOUBLE)" for i, (v, _) in enumerate(ordered))
    body = f"CASE WHEN ({n}) > 0 THEN (0.0D + {s}) / ({n}) ELSE 0.0D END"
    return F.expr(f"element_at(transform(array({tokens}), tk -> element_at(transform(array(array({counts})), "
                  f"c -> {body}), 1)), 1)")


def tone(tokens: str, weighted_lexicon, threshold: float = 0.5) -> tuple[Column, Column]:
    """(subjectivity, label); label ``Formal`` below the threshold else ``Informal``."""
    subj = weighted_mean(tokens, weighted_lexicon)
    return subj, F.when(subj < threshold, F.lit("Formal")).otherwise(F.lit("Informal"))


# ---- lexicons as tables (any number of words, categories and weights) -------------------------

def token_table(df: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """(id, token, n): the distinct tokens of each row with their counts, counted inside the row, so a token travels
    once per text. ``tokens``: SQL for an array of strings."""
    runs = ("transform(filter(sequence(1, size(s)), i -> i = 1 OR s[i - 1] <> s[i - 2]), i -> i)")
    counted = (f"element_at(transform(array(sort_array({tokens})), s -> CASE WHEN size(s) > 0 THEN element_at(transform(array({runs}), "
               "st -> transform(st, (p, k) -> named_struct('token', s[p - 1], 'n', "
               "CAST(coalesce(get(st, k + 1), size(s) + 1) - p AS BIGINT)))), 1) END), 1)")
    return df.select(id_col, F.inline(F.expr(counted)))


def token_lexicon_table(df: DataFrame, lexicon: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """L6 with the lexicon as a table (category, word): rows (id, category, n), n being the number of tokens equal to a word
    of the category, where it is not zero. A word listed twice in a category counts once, a null word or
    category never. The join form is left to the optimizer's measured sizes; per id and category
    the counts add up before they are shuffled."""
    words = lexicon.select("category", F.col("word").alias("token")).where("category IS NOT NULL AND token IS NOT NULL").distinct()
    return (token_table(df, id_col, tokens).join(words, "token")
            .groupBy(id_col, "category").agg(F.sum("n").alias("n")))


def tone_table(df: DataFrame, lexicon: DataFrame, id_col: str, tokens: str, threshold: float = 0.5) -> DataFrame:
    """L7 with the lexicon as a table (word, weight): rows (id, subjectivity, tone) for every id of ``df`` (unique): the
    mean weight over the tokens that the lexicon holds, 0.0 when it holds none; ``Formal`` below the threshold, else
    ``Informal``. A (word, weight) listed twice counts once, rows with a null never."""
    words = lexicon.select(F.col("word").alias("token"), F.col("weight").cast("double").alias("weight")).where(
        "token IS NOT NULL AND weight IS NOT NULL").distinct()
    means = (token_table(df, id_col, tokens).join(words, "token").groupBy(id_col)
             .agg((F.sum(F.col("n") * F.col("weight")) / F.sum("n")).alias("__mean")))
    subj = F.coalesce("__mean", F.lit(0.0))
    return df.select(id_col).join(means, id_col, "left").select(
        id_col, subj.alias("subjectivity"), F.when(subj < threshold, "Formal").otherwise("Informal").alias("tone"))
