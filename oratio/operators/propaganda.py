"""Propaganda search.

Everything for one speech comes from that speech's row, so the search is computed row-locally
with array functions: windows -> chunk gate -> sentences -> lexicon type -> per-type counts ->
top-k -> offsets -> report. There is no explode-and-regroup, hence no shuffle and no copy of
the speech per window; a hot speaker or a group of identical speeches costs what its rows cost.
The long (one row per finding) forms are ``rows_of`` views of the same arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as Q
from ..functions import text as T
from ..functions.lexicons import CHUNK_OVERLAP, CHUNK_SIZE, PROPAGANDA, TOP_TYPES
from ..session import cut_lineage
from .windows import check_window

UNSPECIFIED = "Unspecified"
NOT_PROPAGANDA = "Not propaganda"
NOT_IDENTIFIED = "Not identified"


def findings_sql(speech: str, lexicon=PROPAGANDA, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """P1+P2 as SQL text: ``array<struct<chunk_no, sent_no, type, sentence>>`` of flagged
    sentences, in window then sentence order. A window is kept only if some phrase occurs in it
    (P1); each of its sentences is kept when its predominant category (L2) exists. Hits are
    computed once per sentence (lambdas get no common-subexpression elimination)."""
    step = check_window(size, overlap)
    windows = T.sql_let(T.sql_words(speech), "w",
                        f"CASE WHEN size(w) > 0 THEN transform(sequence(0, size(w) - 1, {step}), "
                        f"i -> array_join(slice(w, i + 1, {size}), ' ')) ELSE CAST(array() AS ARRAY<STRING>) END")
    chunks = f"transform({windows}, (c, k) -> named_struct('chunk_no', k, 'chunk', c))"
    kept = f"filter({chunks}, x -> {Q.any_phrase('lower(x.chunk)', lexicon)})"
    sents = (f"flatten(transform({kept}, x -> transform({T.sql_sentences('x.chunk')}, (s, j) -> "
             f"named_struct('chunk_no', x.chunk_no, 'sent_no', j, 'sentence', s, 'ls', lower(s)))))")
    hs = Q.hits("y.ls", lexicon)
    scored = (f"transform({sents}, y -> named_struct('chunk_no', y.chunk_no, 'sent_no', y.sent_no, "
              f"'sentence', y.sentence, " + ", ".join(f"'h{i}', {h}" for i, h in enumerate(hs)) + "))")
    typ = Q.predominant([f"z.h{i}" for i in range(len(lexicon))], lexicon)
    typed = (f"transform({scored}, z -> named_struct('chunk_no', z.chunk_no, 'sent_no', z.sent_no, "
             f"'type', {typ}, 'sentence', z.sentence))")
    return f"filter({typed}, z -> z.type IS NOT NULL)"


def findings_col(speech: str, lexicon=PROPAGANDA, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """P1+P2 as a column; ``speech`` is a column name (or SQL for a string)."""
    return F.expr(findings_sql(speech, lexicon, size, overlap))


def type_counts_col(findings: str, categories) -> Column:
    """Per type ``struct<neg_n, first_seen, type>`` (neg_n = -count, first_seen = index of the
    type's first finding), types that occur only. ``findings``: column name."""
    items = ", ".join(
        f"named_struct('neg_n', -size(filter({findings}, f -> f.type = {Q.lit(c)})), "
        f"'first_seen', array_position({findings}.type, {Q.lit(c)}) - 1, 'type', {Q.lit(c)})" for c in categories)
    return F.expr(f"filter(array({items}), x -> x.neg_n < 0)")


def top_types_col(counts: Column, k: int = TOP_TYPES) -> Column:
    """The k most frequent types, ties by first appearance (``Counter.most_common``)."""
    return F.slice(F.sort_array(counts), 1, k)


def rows_of(df: DataFrame, keep: list[str], items: str) -> DataFrame:
    """The long form of an array column of structs with a ``type``: ``keep`` and the struct's fields, one row an element.

    A plain ``inline`` makes the optimizer filter on the array's size before the cleaning's shuffle, and
    that filter holds the whole search, written out at each use of ``findings``. The outer form has no such filter; the
    row it gives for an empty or null array has no type."""
    return df.select(*keep, F.inline_outer(items)).where(F.col("type").isNotNull())


def first_offsets(findings: Column, speech) -> Column:
    """Map from each distinct sentence of the findings to the 0-based place of its first occurrence in the speech, -1 when
    absent. Built once per speech: overlapping windows and repeated phrases give a sentence several times, the speech
    is searched for it once. The search itself has to look at the text before: a sentence cut off by a
    window's edge may occur earlier inside another one, where no index of sentence starts would show it."""
    sp = T.col_(speech)
    return T.let(F.array_distinct(F.transform(findings, lambda f: f["sentence"])), lambda ds: F.map_from_arrays(
        ds, F.transform(ds, lambda s: F.call_function("locate", s, sp) - 1)))


def spans_col(findings: Column, top: Column, speech) -> Column:
    """P5+P6: per top type its sentences in order with ``start`` = first occurrence of the
    sentence in the speech (0-based, -1 when absent) and ``end`` exclusive."""
    def with_places(places):
        def span(f):
            return T.let(F.element_at(places, f["sentence"]), lambda at: F.struct(
                f["chunk_no"].alias("chunk_no"), f["sent_no"].alias("sent_no"), at.alias("start"),
                (at + F.length(f["sentence"])).alias("end")))

        return F.transform(top, lambda t: F.struct(
            t["type"].alias("type"), (-t["neg_n"]).alias("n"),
            F.transform(F.filter(findings, lambda f: f["type"] == t["type"]), span).alias("spans")))
    return T.let(first_offsets(findings, speech), with_places)


def report_cols(spans: Column) -> tuple[Column, Column]:
    """(types text, offsets text). Type names: ``_`` -> space, capitalised, one per line;
    offsets ``Type: [a:b], [c:d]`` per line; sentences not found in the speech are left out."""
    types_text = F.array_join(F.transform(spans, lambda t: T.label_text(t["type"])), "\n")
    offsets_text = F.array_join(F.transform(spans, lambda t: F.concat(
        T.label_text(t["type"]), F.lit(": "),
        F.array_join(F.transform(F.filter(t["spans"], lambda s: s["start"] >= 0),
                                 lambda s: F.concat(F.lit("["), s["start"].cast("string"), F.lit(":"),
                                                    s["end"].cast("string"), F.lit("]"))), ", "))), "\n")
    return types_text, offsets_text


def report_col(speech: str = "speech", code: str | None = "code", lexicon=PROPAGANDA, size: int = CHUNK_SIZE,
               overlap: int = CHUNK_OVERLAP, k: int = TOP_TYPES) -> Column:
    """F6+P1-P7 in one expression: ``struct<propaganda_type, offsets>``; intermediate arrays are
    bound once (``let``), nothing is materialised as a column."""
    cats = [c for c, _ in lexicon]

    def with_findings(f):
        def with_spans(spans):
            types_text, offsets_text = report_cols(spans)
            return F.struct(types_text.alias("propaganda_type"), offsets_text.alias("offsets"))

        def with_counts(tc):
            return T.let(spans_col(f, top_types_col(tc, k), F.col(speech)), with_spans)
        return F.when(F.size(f) > 0, T.let(_type_counts_of(f, cats), with_counts)).otherwise(
            F.struct(F.lit(NOT_IDENTIFIED).alias("propaganda_type"), F.lit(None).cast("string").alias("offsets")))

    searched = T.let(findings_col(speech, lexicon, size, overlap), with_findings)
    if code is None:
        return searched
    return F.when(F.col(code) == 1, searched).otherwise(
        F.struct(F.lit(NOT_PROPAGANDA).alias("propaganda_type"), F.lit(None).cast("string").alias("offsets")))


def _type_counts_of(f: Column, categories) -> Column:
    """P3 on a findings array given as a Column (e.g. a bound lambda variable)."""
    arr = F.array(*[F.struct((-F.size(F.filter(f, _type_is(c)))).alias("neg_n"),
                             (F.array_position(f["type"], F.lit(c)) - 1).alias("first_seen"),
                             F.lit(c).alias("type")) for c in categories])
    return F.filter(arr, lambda x: x["neg_n"] < 0)


def _type_is(c: str):
    return lambda f: f["type"] == F.lit(c)


def propaganda_search(df: DataFrame, lexicon=PROPAGANDA, speech: str = "speech", code: str | None = "code",
                      size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, k: int = TOP_TYPES) -> DataFrame:
    """Adds ``findings``, ``type_counts``, ``top_spans``, ``propaganda_type`` and ``offsets``.

    F6: only rows with code 1 are searched; others get (``Not propaganda``, null). A searched
    row without findings gets (``Not identified``, null)."""
    cats = [c for c, _ in lexicon]
    searched = F.col(code) == 1 if code else F.lit(True)
    out = (df.withColumn("findings", F.when(searched, findings_col(speech, lexicon, size, overlap)))
             .withColumn("type_counts", type_counts_col("findings", cats)))
    out = out.withColumn("top_spans", spans_col(F.col("findings"), top_types_col(F.col("type_counts"), k),
                                                F.col(speech)))
    types_text, offsets_text = report_cols(F.col("top_spans"))
    found = F.size(F.col("findings")) > 0
    return (out.withColumn("propaganda_type", F.when(~searched, F.lit(NOT_PROPAGANDA))
                           .when(found, types_text).otherwise(F.lit(NOT_IDENTIFIED)))
               .withColumn("offsets", F.when(searched & found, offsets_text)))


# ---- with a classifier (M4): P1/P2 gate = model OR lexicon ---------------------------------

def scorer_flag(scorer, positive: str = "propaganda"):
    """Flag function for a Python model (``models.Scorer``): text -> label == positive."""
    want = positive[:1].upper() + positive[1:].lower()
    return lambda df, text: df.withColumn("__model", scorer.column(F.col(text)) == F.lit(want))


def model_flag(model, positive_index: int = 1):
    """Flag function for a trained Spark ML pipeline (``models.fit_text_classifier``), JVM-side."""
    from .models import label_from_model

    inp = model.stages[0].getInputCol()  # the text column the pipeline was fitted on

    def flag(df, text):
        names = [str(i) for i in range(max(2, positive_index + 1))]
        src = df if text == inp else df.withColumnRenamed(text, inp)
        out = label_from_model(model, src, inp, names, "__lbl")
        out = out if text == inp else out.withColumnRenamed(inp, text)
        return out.withColumn("__model", F.col("__lbl") == F.lit(str(positive_index))).drop("__lbl")
    return flag


def sql_flag(condition: str):
    """Flag function for a deterministic rule: SQL in which ``{text}`` stands for the text column."""
    return lambda df, text: df.withColumn("__model", F.expr(condition.format(text=text)))


def flag_once(df: DataFrame, text: str, flag, undecided: Column) -> DataFrame:
    """``df`` with ``__model``: the flag of each ``undecided`` row's text, every distinct text scored once (false for the
    other rows). The distinct texts, found by hash and text, are scored into a table of the checkpoint folder, so no later
    stage or retry calls the model again; the flags come back by hash with a check of the text itself."""
    h = F.xxhash64(F.col(text))
    asked = df.where(undecided).select(h.alias("__h"), F.col(text).alias(text)).distinct()
    # written before it is filtered: a filter on the flag would be moved below the distinct, where texts repeat
    told = cut_lineage(flag(asked, text).select(F.col("__h").alias("__g"), F.col(text).alias("__text"), "__model")).where("__model")
    keyed = df.withColumn("__h", F.when(undecided, h))
    flagged = keyed.join(told.drop("__model"), (F.col("__h") == F.col("__g")) & (F.col(text) == F.col("__text")), "left")
    return flagged.withColumn("__model", F.col("__g").isNotNull()).drop("__h", "__g", "__text")


def propaganda_search_scored(df: DataFrame, flag, lexicon=PROPAGANDA, id_col: str = "speech_id",
                             speech: str = "speech", code: str | None = "code", size: int = CHUNK_SIZE,
                             overlap: int = CHUNK_OVERLAP, k: int = TOP_TYPES) -> DataFrame:
    """P1-P7 with a classifier: a window is kept when the model flags it or a phrase occurs in
    it; a sentence of a kept window is a finding when the model flags it or the lexicon types
    it; model-only findings get the type ``Unspecified``.

    The model is asked once per distinct window and once per distinct sentence (windows overlap by a
    quarter, speeches repeat phrases), and only where the lexicon has not decided yet. This path explodes
    windows and sentences and regroups the findings per speech (``collect_list`` bounded by one
    speech's findings; the grouping key is the unique speech id, so no key is hot), then reuses
    the row-local P3-P7."""
    from .windows import sliding_windows

    searched = df.where(F.col(code) == 1) if code else df
    chunks = sliding_windows(searched, id_col, speech, size, overlap).withColumn(
        "__lex", F.expr(Q.any_phrase("lower(chunk)", lexicon)))
    kept = flag_once(chunks, "chunk", flag, ~F.col("__lex")).where(F.col("__model") | F.col("__lex"))
    sents = kept.select(id_col, "chunk_no", F.posexplode(T.sentences("chunk")).alias("sent_no", "sentence"))
    sents = sents.withColumn("__lex", F.expr(Q.predominant(Q.hits("lower(sentence)", lexicon), lexicon)))
    sents = flag_once(sents, "sentence", flag, F.col("__lex").isNull())
    typed = sents.withColumn("type", F.coalesce("__lex", F.when(F.col("__model"), F.lit(UNSPECIFIED))))
    found = (typed.where(F.col("type").isNotNull())
                  .groupBy(id_col)
                  .agg(F.sort_array(F.collect_list(F.struct("chunk_no", "sent_no", "type", "sentence")))
                       .alias("findings")))
    cats = [c for c, _ in lexicon] + [UNSPECIFIED]
    out = df.join(found, id_col, "left")
    searched_c = F.col(code) == 1 if code else F.lit(True)
    out = out.withColumn("findings", F.when(searched_c, F.coalesce(
        F.col("findings"), F.array().cast("array<struct<chunk_no:int,sent_no:int,type:string,sentence:string>>"))))
    out = out.withColumn("type_counts", type_counts_col("findings", cats))
    out = out.withColumn("top_spans", spans_col(F.col("findings"), top_types_col(F.col("type_counts"), k),
                                                F.col(speech)))
    types_text, offsets_text = report_cols(F.col("top_spans"))
    has = F.size(F.col("findings")) > 0
    return (out.withColumn("propaganda_type", F.when(~searched_c, F.lit(NOT_PROPAGANDA))
                           .when(has, types_text).otherwise(F.lit(NOT_IDENTIFIED)))
               .withColumn("offsets", F.when(searched_c & has, offsets_text)))
