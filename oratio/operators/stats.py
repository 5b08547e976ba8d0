"""Text statistics: narrative structure, readability, persuasion.

Every metric is a function of one speech, so each is a JVM expression on the row (array
functions over its sentences/words); only the per-speaker summary (A12) groups, and it
aggregates partially map-side, so a speaker holding a third of all rows is still cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicons import (NOT_SUPERLATIVE, PERSUASION, PERSUASION_WEIGHTS, SUPERLATIVE_WORDS)
from ..functions import sqlexpr as Q
from .lexicon import token_counts_sql


def _sum_int(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


# ---- A1-A2 narrative structure ---------------------------------------------------------

def narrative_from_lengths(lengths: Column) -> Column:
    """A1 from the per-sentence word counts: mean, population std, count, mean / (std + 1)."""
    def stats(ls):
        n = F.size(ls)

        def with_mean(mean):
            std = F.sqrt(F.aggregate(ls, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n)
            return F.struct(mean.alias("avg_sentence_length"), std.alias("sentence_length_std"),
                            n.cast("bigint").alias("total_sentences"), (mean / (std + 1)).alias("complexity"))
        return F.when(n > 0, T.let(_sum_int(ls) / n, with_mean))
    return T.let(lengths, stats)


def narrative_col(text: str = "speech") -> Column:
    """A1 over the non-empty sentences (split rule of ``functions.text``)."""
    lengths = F.transform(T.nonempty_sentences(F.col(text)), lambda s: F.size(T.words(s)))
    return narrative_from_lengths(lengths)


def add_narrative(df: DataFrame, text: str = "speech", out: str = "narrative") -> DataFrame:
    return df.withColumn(out, narrative_col(text))


def narrative_text(narrative: str) -> Column:
    """A2: the four metrics as ``Name: value`` lines, floats as Python's ``%.3f`` (exact
    half-even), the count as an integer. ``narrative``: column path of the struct."""
    f = T.python_fixed_sql
    return F.expr(
        f"CASE WHEN {narrative} IS NOT NULL THEN concat_ws('\\n', "
        f"concat('Average Sentence Length: ', {f(narrative + '.avg_sentence_length')}), "
        f"concat('Sentence Length Variation: ', {f(narrative + '.sentence_length_std')}), "
        f"concat('Total Sentences: ', CAST({narrative}.total_sentences AS STRING)), "
        f"concat('Complexity Score: ', {f(narrative + '.complexity')})) END")


# ---- A3-A8 readability -------------------------------------------------------------------

_PLAIN_VOWELS = ["a", "e", "i", "o", "u", "y"]


def _ends_consonant_then(lw: Column, tail: str) -> Column:
    """``lw`` ends with ``tail`` right after a character outside ``aeiouy`` (regex
    ``[^aeiouy]tail$`` spelled with string functions)."""
    n = len(tail) + 1
    return (lw.endswith(tail) & (F.length(lw) >= n)
            & ~F.substring(lw, -n, 1).isin(*_PLAIN_VOWELS))


def syllables(word: Column) -> Column:
    """Vowel groups, minus a silent final ``e`` (not ``-le``), at least one."""
    def count(lw):
        return T.let(F.regexp_count(lw, F.lit(T.VOWELS)), lambda v: F.greatest(
            F.lit(1), v - ((v > 1) & _ends_consonant_then(lw, "e")
                           & ~_ends_consonant_then(lw, "le")).cast("int")))
    return T.let(F.lower(word), count)


_GROUP, _SILENT = "\u0001", "\u0002"


def syllables_of(words: Column) -> Column:
    """``syllables`` of every word of an array, in passes over the words joined by spaces rather than per word:
    a final ``e`` after a consonant (not ``-le``) gets a silent mark, each vowel group becomes one group mark, and all
    other letters go; what is left of a word is its groups and perhaps the silent mark."""
    text = F.lower(F.array_join(words, " "))
    text = F.regexp_replace(text, r"(?<=[^aeiouy ])(?<![^aeiouy ]l)e(?= |\z)", "e" + _SILENT)
    text = F.regexp_replace(text, T.VOWELS, _GROUP)
    text = F.regexp_replace(text, f"[^ {_GROUP}{_SILENT}]+", "")

    def count(m):
        return F.when(m.endswith(_SILENT), F.greatest(F.lit(1), F.length(m) - 2)).otherwise(F.greatest(F.lit(1), F.length(m)))
    return F.when(F.size(words) > 0, F.transform(F.split(text, " ", -1), count)).otherwise(F.array().cast("array<int>"))


def counters_col(text: str = "speech") -> Column:
    """A3 in one expression: struct(words, sentences, syllables, characters, polysyllables)."""
    def with_words(w):
        return T.let(syllables_of(w), lambda syl: F.struct(
            F.size(w).cast("bigint").alias("words"),
            F.greatest(F.lit(1), F.size(T.nonempty_sentences(F.col(text)))).cast("bigint").alias("sentences"),
            _sum_int(syl).alias("syllables"),
            F.length(F.array_join(w, "")).cast("bigint").alias("characters"),
            F.size(F.filter(syl, lambda x: x >= 3)).cast("bigint").alias("polysyllables")))
    return T.let(F.regexp_extract_all(F.col(text), F.lit(T.WORD), 0), with_words)


def add_counters(df: DataFrame, text: str = "speech", out: str = "counters") -> DataFrame:
    """A3 as a column."""
    return df.withColumn(out, counters_col(text))


def _ordinal(n: Column) -> Column:
    suffix = (F.when((n % 100).isin(11, 12, 13), "th").when(n % 10 == 1, "st")
               .when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th"))
    return F.concat(n.cast("string"), suffix)


def readability(counters) -> Column:
    """A4-A8 from the counters struct: FRE, FKGL, Fog, SMOG, text standard; null without words.

    Give a column name to stay in generated code; any other expression is bound once first
    (each count is used many times below, and an unbound expression would be re-evaluated)."""
    if isinstance(counters, str):
        return _readability(F.col(counters))
    return T.let(counters, _readability)


def _readability(c: Column) -> Column:
    W = c["words"].cast("double")
    S = c["sentences"].cast("double")
    Y = c["syllables"].cast("double")
    P = c["polysyllables"].cast("double")
    C = c["characters"].cast("double")
    fre = F.lit(206.835) - F.lit(1.015) * W / S - F.lit(84.6) * Y / W
    fk = F.lit(0.39) * W / S + F.lit(11.8) * Y / W - F.lit(15.59)
    fog = F.lit(0.4) * (W / S + F.lit(100.0) * P / W)
    smog = F.when(S < 3, F.lit(0.0)).otherwise(F.lit(1.0430) * F.sqrt(F.lit(30.0) * P / S) + F.lit(3.1291))
    cli = F.lit(0.0588) * F.lit(100.0) * C / W - F.lit(0.296) * F.lit(100.0) * S / W - F.lit(15.8)
    ari = F.lit(4.71) * C / W + F.lit(0.5) * W / S - F.lit(21.43)
    grades = F.array(*[F.floor(g + F.lit(0.5)) for g in (fk, fog, smog, cli, ari)])
    mode = T.let(grades, lambda gs: F.array_min(F.transform(gs, lambda g: F.struct(
        (-F.size(F.filter(gs, lambda h: h == g))).alias("neg"), g.alias("g"))))["g"])
    standard = F.concat(_ordinal(mode - 1), F.lit(" and "), _ordinal(mode), F.lit(" grade"))
    return F.when(W > 0, F.struct(fre.alias("flesch_reading_ease"), fk.alias("flesch_kincaid_grade"),
                                  fog.alias("gunning_fog"), smog.alias("smog_index"),
                                  standard.alias("text_standard")))


# ---- A9-A11 persuasion -------------------------------------------------------------------



def superlative_sql(t: str) -> str:
    """``most/least/best/worst`` or a word of 3+ letters followed by ``est`` that is not in the
    exclusion list (cheap tests first; the letters-only regex runs on ``…est`` tokens only)."""
    return (f"({t} IN {Q.in_list(SUPERLATIVE_WORDS)} OR (endswith({t}, 'est') AND length({t}) >= 6 "
            f"AND NOT {t} IN {Q.in_list(NOT_SUPERLATIVE)} AND {t} RLIKE '^\\\\p{{L}}+$'))")


def persuasion_counts_sql(text: str, tokens: str) -> str:
    """A9 counts as SQL: superlatives, questions (sentences ending in ``?``), four lexicon
    categories, total tokens."""
    names = [n for n, _ in PERSUASION_WEIGHTS]
    exprs = [f"size(filter({tokens}, t -> {superlative_sql('t')}))",
             f"size(filter({T.sql_sentences(text)}, s -> s RLIKE '\\\\?{T._esc(T.WS)}*$'))"]
    exprs += [token_counts_sql(tokens, ws) for _, ws in PERSUASION]
    fields = ", ".join(f"'{n}', CAST({e} AS BIGINT)" for n, e in zip(names, exprs))
    return f"named_struct({fields}, 'total_tokens', CAST(size({tokens}) AS BIGINT))"


def add_persuasion(df: DataFrame, text: str = "speech", out: str = "persuasion") -> DataFrame:
    return df.withColumn(out, persuasion_col(text))


def persuasion_col(text: str = "speech") -> Column:
    """Counts and weighted scores. score = count / total tokens * weight; total_score
    = their sum rounded to 3; no tokens -> all 0.0."""
    pc = T.sql_let(persuasion_counts_sql(text, "pt"), "pc", "pc")
    counts = T.sql_let(T.sql_ptokens(text), "pt", pc)
    terms = [f"CASE WHEN pc.total_tokens > 0 THEN pc.{n} / pc.total_tokens * CAST({w!r} AS DOUBLE) ELSE 0.0D END"
             for n, w in PERSUASION_WEIGHTS]
    scores = ", ".join(f"'{n}', {e}" for (n, _), e in zip(PERSUASION_WEIGHTS, terms))
    total = f"CAST({T.python_fixed_sql(' + '.join(terms), 3)} AS DOUBLE)"  # Python's round(x, 3)
    body = f"named_struct('counts', pc, 'scores', named_struct({scores}, 'total_score', {total}))"
    return F.expr(T.sql_let(counts, "pc", body))


def persuasion_text(scores: str) -> Column:
    """``Title Case: value`` lines, values printed as Python prints floats.
    ``scores``: column path of the scores struct (e.g. ``persuasion.scores``)."""
    names = [n for n, _ in PERSUASION_WEIGHTS] + ["total_score"]
    lines = ", ".join(f"concat({Q.lit(Q.title(n) + ': ')}, {T.python_float_text_sql(f'{scores}.{n}')})" for n in names)
    return F.expr(f"concat_ws('\\n', {lines})")


# ---- A12 per speaker -----------------------------------------------------------------------

def per_speaker(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Per surname the number of speeches and the mean of each metric."""
    return df.groupBy("surname").agg(F.count(F.lit(1)).alias("speeches"),
                                     *[F.avg(c).alias(n) for n, c in metrics.items()])
