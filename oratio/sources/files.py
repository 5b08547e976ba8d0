"""Speech table source and wide-table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Tokens a pandas-style reader turns into a missing value (plus the empty field).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _na(c: str) -> F.Column:
    return F.when(F.col(c).isin(*NA_TOKENS), F.lit(None)).otherwise(F.col(c))


SPEECH_FIELDS = "surname string, code string, speech string"
# Splits whose start states are sent to every task (a row of some hundred bytes each); more are joined.
BROADCAST_SPLITS = 100_000
FILE_SHIFT = 42  # speech_id: number of the file above, position in the file below (4 TB a file)


def _scanner(sep: str, quote: str):
    """Function (line, inside) -> whether the line ends inside a quoted field. A quote opens a field only at the field's
    start; doubled quotes stay inside; what follows a closing quote belongs to the field up to the separator."""
    import re

    s, q = re.escape(sep), re.escape(quote)
    closed = re.compile(f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?!{q})[^{s}]*+")  # from inside a quoted field to the field's end
    plain = re.compile(f"(?:[^{q}{s}][^{s}]*+)?")

    def ends_inside(line: str, inside: bool) -> bool:
        at = 0
        while True:
            if not inside and line.startswith(quote, at):
                inside, at = True, at + len(quote)
            m = (closed if inside else plain).match(line, at)
            if m is None:
                return True  # no closing quote on this line
            inside, at = False, m.end()
            if at == len(line):
                return False
            at += len(sep)

    return ends_inside


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, no, value) of every line; ``no`` grows within a split. Spark splits files over tasks by
    ``spark.sql.files.maxPartitionBytes``; a line belongs to the split it begins in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("no"), "value")


def _split_states(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """(file, split, inside, number): whether each split begins inside a quoted field, and its file's place among the sorted
    names. Every split is read for both answers at
    once; its lines then keep, swap or fix the state, and a running window over the splits of a file (one small row
    each) composes those effects from the file's start."""
    def run(batches):
        scan, key, ends = _scanner(sep, quote), None, None
        for b in batches:
            for f, at, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if (f, at) != key:
                    if key:
                        yield _effect(key, ends)
                    key, ends = (f, at), [False, True]
                if quote in line:
                    if ends[0] == ends[1]:
                        ends = [scan(line, ends[0])] * 2
                    else:
                        both = scan(line, False), scan(line, True)
                        ends = [both[e] for e in ends]
        if key:
            yield _effect(key, ends)

    effects = lines.mapInArrow(run, "file string, split long, when_out boolean, when_in boolean")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("split")
    swap = (F.col("when_out") & ~F.col("when_in")).cast("int")
    fixed = F.when(F.col("when_out") == F.col("when_in"), F.col("when_out").cast("int"))
    e = effects.select("file", "split", swap.alias("swap"), fixed.alias("fixed"))
    e = e.withColumn("swaps", F.sum("swap").over(upto))
    e = e.withColumn("base", F.expr("(fixed + swaps) % 2"))  # what the fixed state would be with no swap up to here
    last, swaps = F.last("base", ignorenulls=True).over(before), F.coalesce(F.sum("swap").over(before), F.lit(0))
    numbered = e.select("file").distinct().select("file", F.row_number().over(Window.orderBy("file")).cast("long").alias("number"))
    return e.select("file", "split", ((F.coalesce(last, F.lit(0)) + swaps) % 2 == 1).alias("inside")).join(numbered, "file")


def _effect(key, ends):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([ends[0]]), pa.array([ends[1]])],
                                      names=["file", "split", "when_out", "when_in"])


def read_records(spark: SparkSession, path: str, sep: str = "\t", quote: str = '"') -> DataFrame:
    """(number, pos, record): the records of delimited text files, line breaks inside quoted fields kept, every file split
    over tasks. ``number`` is the file's place among the sorted names, ``pos`` grows with the record's place in its file.

    The files are read three times: for the state at each split's start, for the records, and for the pieces of
    records that reach over a split's end (at most two a split), which are put together by file and place. A trailing
    carriage return is cut from each line; empty records are left out."""
    lines = _lines(spark, path)
    states = cut_lineage(_split_states(lines, sep, quote))
    if states.count() <= BROADCAST_SPLITS:
        stated = lines.join(F.broadcast(states), ["file", "split"])  # keeps the order of the scan
    else:
        stated = lines.join(states, ["file", "split"]).repartition("file", "split").sortWithinPartitions("file", "split", "no")
    stated = stated.select("number", "split", "no", "value", "inside")

    def run(batches):
        import pyarrow as pa

        scan, key, at, inside, head, held, start = _scanner(sep, quote), None, 0, False, False, [], 0
        last = None
        rows = []

        def put(kind):
            rows.append((key[0], key[1] + start, kind, "\n".join(held)))

        for b in batches:
            for f, split, no, line, state in zip(*(c.to_pylist() for c in b.columns)):
                if (f, split) != key:
                    if held:  # the split ends inside a record: it was begun here, or runs through the whole split
                        put(3 if head else 1)
                    key, at, inside, head, held, last = (f, split), 0, state, state, [], None
                if last is not None and no <= last:
                    raise RuntimeError("lines out of order")
                last = no
                if not held:
                    start = at
                held.append(line[:-1] if line.endswith("\r") else line)
                inside = scan(line, inside) if quote in line or inside else False
                if not inside:
                    put(2 if head else 0)
                    held, head = [], False
                at += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["number", "pos", "kind", "record"])
                rows.clear()
        if held:
            put(3 if head else 1)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["number", "pos", "kind", "record"])

    pieces = stated.mapInArrow(run, "number long, pos long, kind long, record string")
    whole = pieces.where("kind = 0").select("number", "pos", "record")
    place = Window.partitionBy("number").orderBy("pos")
    cut = pieces.where("kind > 0").withColumn("g", F.sum((F.col("kind") == 1).cast("int")).over(place))
    joined = cut.groupBy("number", "g").agg(F.sort_array(F.collect_list(F.struct("pos", "record"))).alias("p")).select(
        "number", F.col("p")[0]["pos"].alias("pos"), F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.unionAll(joined).where("record <> ''")


def read_speeches(spark: SparkSession, path: str, quote: str | None = '"', multi_line: bool = True) -> DataFrame:
    """Headerless tab-separated (surname, code, speech). NA tokens -> null; code parsed as
    a number per row (``1.0`` counts as 1, text rows are dropped later by F4, not the whole file);
    extra fields are ignored; quoted fields may span lines. ``speech_id`` follows file order
    within each file (deterministic; used as "first" by the duplicate removal).

    ``multi_line`` (default) keeps line breaks inside quoted fields; the files are split over tasks all the same
    (``read_records``). Give False for files without such breaks: they are read once."""
    options = {"sep": "\t", "mode": "PERMISSIVE", "emptyValue": "", "nullValue": "\u0000", "quote": quote or "\u0000"}
    if quote:
        options["escape"] = quote
    if multi_line and quote:
        records = read_records(spark, path, "\t", quote)
        place = F.shiftleft("number", FILE_SHIFT).bitwiseOR(F.col("pos"))
        df = records.select(place.alias("speech_id"), F.from_csv("record", SPEECH_FIELDS, options).alias("r")).select("speech_id", "r.*")
    else:
        reader = spark.read.schema(SPEECH_FIELDS).options(header="false", **options)
        df = reader.csv(path).select(F.monotonically_increasing_id().alias("speech_id"), "*")
    df = df.select("speech_id", _na("surname").alias("surname"), _na("code").alias("code"), _na("speech").alias("speech"))
    num = F.expr("try_cast(code AS DOUBLE)")
    code = F.when(num == F.floor(num), num.cast("int"))
    return df.withColumn("code", code).select("speech_id", "surname", "code", "speech")


def write_speech_file(df: DataFrame, path: str, mode: str = "error") -> None:
    """The input format of S1: headerless, tab-separated (surname, code, speech); fields with
    tabs, quotes or line breaks are quoted, quotes doubled."""
    (df.select("surname", F.col("code").cast("string").alias("code"), "speech").write.mode(mode)
       .option("sep", "\t").option("header", "false").option("quote", '"').option("escape", '"')
       .option("nullValue", "").csv(path))


def write_speeches(df: DataFrame, path: str, display_names: bool = True, mode: str = "overwrite") -> None:
    """Wide table as CSV with header (a directory of part files written in parallel); null
    and empty string stay distinct (empty is written as ``""``)."""
    from ..plans.enrich import OUTPUT

    if display_names:
        names = dict(OUTPUT)
        df = df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns if c != "speech_id"])
    # minimal quoting: null is an empty field, the empty string is written as ""
    (df.write.mode(mode).option("header", "true").option("escape", '"')
       .option("emptyValue", '""').csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Typed sink for the same table (keeps arrays/structs and numbers)."""
    df.write.mode(mode).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: snapshot of politician pages (surname, rank, title, first_sentence, html)."""
    return spark.read.parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Stored model responses (speech, response, seq)."""
    return spark.read.parquet(path)
