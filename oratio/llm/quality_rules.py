"""Quality rules: a threshold table compiled into one Spark projection (JVM expressions only).

``document_stats`` is the projection of raw counts, ``RULES`` the threshold table (a ratio of two
counts, the least and the most it may be), ``compile_rules`` turns the table into one boolean
expression. No Python runs on the executors and nothing is shuffled.

Defined cases: a null or blank text has no words, so it fails the length rule; a ratio whose
denominator is 0 counts as 0; ties and repeated rows are judged one by one; an empty table gives
an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SQL_GAP, SQL_WORD_CHAR, free_name, let_sql

# Function words of the languages the corpus holds, counted once per form (as written or capitalised).
STOP_WORDS = [
    "the", "of", "and", "to", "in", "that", "for", "with", "is", "was", "on", "it", "be", "have",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "pour", "est",
    "der", "die", "das", "und", "den", "von", "ist", "mit", "ein", "zu",
    "el", "los", "las", "y", "en", "del", "por", "con", "una", "para",
]


@dataclass(frozen=True)
class Rule:
    """``least <= value / per <= most``; ``per`` None compares the count itself."""

    name: str
    value: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


# Method thresholds, after the published rules for web text (length, mean word length, symbols,
# stop words, repeated and elliptic lines). All are parameters.
RULES = [
    Rule("length", "n_words", least=50),
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", least=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.3),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.5),
    Rule("elliptic_lines", "n_elliptic_lines", "n_lines", most=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
]

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
         "n_elliptic_lines", "n_bullet_lines"]


def _repeat_words_sql(w: str) -> str:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by their 64-bit hashes. Texts whose hashes are all different (nearly all
    prose) end after one hash set; otherwise (hash, position) pairs are sorted, positions equal
    to a neighbour are marked, and the union of the marked windows is summed as the distance to
    the next mark, 3 at most."""
    hashes = f"transform(sequence(0, size({w}) - 3), i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2]))"
    pairs = "sort_array(transform(hs, (h, i) -> struct(h, i)))"
    marked = ("sort_array(transform(filter(transform(sp, (x, j) -> struct(x.i AS i, "
              "(j > 0 AND sp[greatest(j - 1, 0)].h = x.h) OR (j < size(sp) - 1 AND sp[least(j + 1, size(sp) - 1)].h = x.h) AS d)), "
              "x -> x.d), x -> x.i))")
    covered = ("aggregate(ms, struct(0 AS n, -3 AS last), (a, m) -> struct(a.n + least(3, m - a.last) AS n, m AS last), "
               "a -> a.n)")
    slow = let_sql(pairs, "sp", let_sql(marked, "ms", covered))
    body = f"CASE WHEN size(array_distinct(hs)) = size(hs) THEN 0 ELSE {slow} END"
    return f"CASE WHEN size({w}) < 4 THEN 0 ELSE {let_sql(hashes, 'hs', body)} END"


def stats_sql(text: str) -> str:
    """SQL for the struct of counts of one text; each intermediate array is built once."""
    stops = ", ".join(f"'{f}'" for s in STOP_WORDS for f in (s, s.capitalize()))
    words = f"array_remove(split(t, '{SQL_GAP}'), '')"
    lines = f"filter(split(t, '\\n'), x -> x rlike '{SQL_WORD_CHAR}')"
    fields = [
        ("n_words", "size(w)"),
        ("word_chars", "length(array_join(w, ''))"),
        ("n_symbols", "regexp_count(t, '[#*$%&|<>]')"),
        ("n_dup_lines", "size(l) - size(array_distinct(l))"),
        ("n_repeat_words", _repeat_words_sql("w")),
        ("n_lines", "size(l)"),
        ("n_stop_words", f"size(array_intersect(w, array({stops})))"),
        ("n_elliptic_lines", "size(filter(l, x -> x rlike '(\\\\.\\\\.\\\\.|…)[\\\\x20\\\\x09-\\\\x0D]*$'))"),
        ("n_bullet_lines", "size(filter(l, x -> x rlike '^[\\\\x20\\\\x09-\\\\x0D]*[-*•]'))"),
    ]
    struct = "named_struct(" + ", ".join(f"'{n}', CAST({e} AS BIGINT)" for n, e in fields) + ")"
    return let_sql(f"coalesce({text}, '')", "t", let_sql(words, "w", let_sql(lines, "l", struct)))


def compile_rules(stats: Column, rules: list[Rule] = RULES) -> Column:
    """One boolean expression: every rule of the table holds."""
    passed = F.lit(True)
    for r in rules:
        v = stats[r.value]
        if r.per:
            v = F.when(stats[r.per] > 0, v / stats[r.per]).otherwise(F.lit(0.0))
        if r.least is not None:
            passed = passed & (v >= F.lit(r.least))
        if r.most is not None:
            passed = passed & (v <= F.lit(r.most))
    return passed


def base_failed(stats: Column) -> Column:
    """Too short, or more than half of the words stand in repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def quality_rules(df: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``df`` with a struct column of counts and verdicts, named ``quality`` (or the next free name):
    the counts of ``STATS``, ``base_failed`` and ``kept``."""
    out = free_name(df, "quality")
    s = free_name(df, "__stats")
    quoted = "`" + text.replace("`", "``") + "`"
    with_stats = df.withColumn(s, F.expr(stats_sql(quoted)))
    st = F.col(s)
    failed = base_failed(st)
    return with_stats.withColumn(out, F.struct(*[st[n].alias(n) for n in STATS], failed.alias("base_failed"),
                                               (~failed & compile_rules(st, rules)).alias("kept"))).drop(s)


def keep_good(df: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The rows that pass, with their own columns only."""
    judged = quality_rules(df, text, rules)
    return judged.where(F.col(judged.columns[-1])["kept"]).select(*df.columns)
