"""Files with line breaks inside quoted fields, split over tasks, against Spark's whole-file reader and csv."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from oratio.sources.files import _scanner, read_records, read_speeches


def whole_file(spark, path):
    """The reader that takes a file in one task."""
    return (spark.read.schema("surname string, code string, speech string").option("sep", "\t").option("multiLine", "true")
            .option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "\u0000").csv(path))


def rows_of(rnd, n):
    parts = ["plain words", "two\nlines", 'say "this"', "tab\there", "\n\n", '"', '""\n"', "end.", "café \U0001f600", "long " * 30]
    return [(f"name{i}", str(i % 2), "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6)))) for i in range(n)]


@pytest.fixture(params=[17, 64, 700, 1 << 20])
def split_bytes(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def test_equal_to_whole_file_reader(spark, tmp_path, split_bytes):
    rnd = random.Random(1)
    for f in range(2):
        with open(tmp_path / f"s{f}.tsv", "w", newline="") as out:
            csv.writer(out, delimiter="\t", lineterminator="\n").writerows(rows_of(rnd, 25))
    path = str(tmp_path)
    got = read_speeches(spark, path)
    if split_bytes < 1000:
        assert spark.read.text(path).rdd.getNumPartitions() > 2
    want = sorted(map(tuple, whole_file(spark, path).collect()))
    assert sorted((r.surname, str(r.code), r.speech) for r in got.collect()) == want
    ids = [r.speech_id for r in got.collect()]
    assert len(set(ids)) == 50
    in_order = []
    for f in range(2):  # ids follow the files and their order
        with open(tmp_path / f"s{f}.tsv", newline="") as src:
            in_order += [r[2] for r in csv.reader(src, delimiter="\t")]
    assert [r.speech for r in got.orderBy("speech_id").collect()] == [None if t == "" else t for t in in_order]


def test_quotes_that_do_not_open_a_field(spark, tmp_path, split_bytes):
    text = ('Rossi\t1\tA 5" pipe\nBianchi\t0\t"a ""b""\nc"\textra\nVerdi\t1.0\t"closed" and "more\n\n'
            'Neri\t1\t""\nGialli\t1\tN/A\nBlu\t0\t"x\n\ny"\n')
    (tmp_path / "t.tsv").write_text(text)
    got = read_speeches(spark, str(tmp_path / "t.tsv")).orderBy("speech_id").collect()
    want = whole_file(spark, str(tmp_path / "t.tsv")).collect()
    assert [r.surname for r in got] == [r.surname for r in want]
    assert [r.speech for r in got] == [None if r.speech in ("", "N/A") else r.speech for r in want]


def test_carriage_returns_and_one_long_record(spark, tmp_path, split_bytes):
    body = "line\r\n" * 200
    (tmp_path / "c.tsv").write_bytes(f'A\t1\t"{body}end"\r\nB\t0\tshort\r\n'.encode())
    rows = read_speeches(spark, str(tmp_path / "c.tsv")).orderBy("speech_id").collect()
    assert [(r.surname, r.code) for r in rows] == [("A", 1), ("B", 0)]
    assert rows[0].speech == "line\n" * 200 + "end" and rows[1].speech == "short"


def test_scanner_states():
    scan = _scanner("\t", '"')
    for line, out, inside in [("a\tb", False, True), ('a\t"b', True, False), ('b"\tc', False, False), ('x"y', False, False),
                              ('""', False, True), ('"a""b', True, False), ("", False, True), ('"\t"', False, True)]:
        assert (scan(line, False), scan(line, True)) == (out, inside), line


def test_empty_file_and_many_splits(spark, tmp_path, monkeypatch):
    (tmp_path / "e.tsv").write_text("")
    assert read_speeches(spark, str(tmp_path / "e.tsv")).count() == 0
    from oratio.sources import files
    monkeypatch.setattr(files, "BROADCAST_SPLITS", 0)
    (tmp_path / "f.tsv").write_text('A\t1\t"x\ny"\nB\t0\tz\n')
    got = read_records(spark, str(tmp_path / "f.tsv")).orderBy("pos").select(F.col("record")).collect()
    assert [r.record for r in got] == ['A\t1\t"x\ny"', "B\t0\tz"]
