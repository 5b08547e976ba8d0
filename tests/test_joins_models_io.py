"""Joins and parsing (J1-J3, X1-X4), models (M1, M6, M7), embeddings (E1-E3), files (S1-S2),
streaming, the enrichment (Z1) and the driver entry points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from oratio.operators import embed as E
from oratio.operators import models as M
from oratio.operators import profiles as J
from oratio.operators import responses as R

PAGE = """<div class="nickname">Ada Example Rossi</div>
<table class="infobox vcard">
<tr><th>Born</th><td><span class="bday">1901-02-03</span><br><a href="#">Salerno</a>, Italy</td></tr>
<tr><th>Died</th><td><span style="display:none">(1980-04-05)</span><br><a href="#">Naples</a>, Italy</td></tr>
<tr><th>Political party</th><td><a href="#">Example Party</a></td></tr>
</table>"""


def test_parse_responses(spark):  # c8, c9, c10
    df = spark.createDataFrame([(1, "2024-01-01$Rome, RM$Rally$Cost of $5$None$S"), (2, None),
                                (3, "a$b$c$d$e$f$g$A: x.;B: y.")], "id long, response string")
    out = {r.id: r for r in R.parse_responses(df).collect()}
    assert [out[1][f] for f in R.FIELDS] == ["2024-01-01", "Rome, RM", "Rally", "Cost of ", "5", "None", "S", "N/A"]
    assert [out[2][f] for f in R.FIELDS] == ["N/A"] * 8 and out[2].fields_found == 0
    assert out[3].underlying_narrative == "A: x.\n\nB: y."


def test_latest_response_wins(spark):  # c7
    resp = spark.createDataFrame([("s", "old", 1), ("s", "new", 2)], "speech string, response string, seq long")
    sp = spark.createDataFrame([(1, "s"), (2, "t")], "speech_id long, speech string")
    out = {r.speech_id: r for r in R.add_responses(sp, R.latest_responses(resp)).collect()}
    assert out[1].speech_date == "new" and out[2].speech_date == "N/A"


def test_profile_extraction(spark):  # X3 fixture and variants
    assert J.parse_profile(PAGE) == ("Ada Example Rossi", "1901-02-03", "Salerno, Italy", "1980-04-05",
                                     "Naples, Italy", "Example Party")
    plain = PAGE.replace('<a href="#">Salerno</a>, Italy', "Salerno, Italy")
    assert J.parse_profile(plain)[2] == "Salerno, Italy"
    alive = PAGE.split("<tr><th>Died")[0] + "</table>"
    assert J.parse_profile(alive)[3:5] == (None, None)
    assert J.parse_profile("<p>no box</p>") == (None,) * 6
    assert J.parse_profile(PAGE.replace("infobox vcard", "biography infobox"))[0] == "Ada Example Rossi"
    pages = spark.createDataFrame([("rossi", PAGE), ("none", "<p>x</p>")], "surname string, html string")
    out = {r.surname: r for r in J.extract_profiles(pages).collect()}
    assert out["rossi"].party == "Example Party" and out["none"].full_name is None


def test_deep_page_gives_values(spark):  # X3: unclosed tags nest thousands deep
    deep = "<p>" * 5000 + "x"
    assert J.parse_profile(PAGE + deep)[0] == "Ada Example Rossi"
    assert J.parse_profile(deep + PAGE)[5] == "Example Party"
    assert J.parse_profile(PAGE.replace("Salerno</a>", "Salerno" + deep))[1] == "1901-02-03"


def _speeches(spark):
    text = "They are corrupt and they lie to you. " * 10
    return spark.createDataFrame([(1, "rossi", 1, text), (2, "bianchi", 0, text + "Calm words."), (3, "verdi", 1, text + "End.")],
                                 "speech_id long, surname string, code int, speech string")


def test_pages_to_enrichment(spark, tmp_path):  # S3, S4 readers; J2 -> X3 -> J1 inside Z1
    from oratio.plans.enrich import enrich
    from oratio.sources.files import read_pages, read_responses, write_parquet

    who = "Ada Rossi is a politician."
    pages = spark.createDataFrame(
        [("rossi", 0, "a river", "A river.", PAGE.replace("Ada", "Not")), ("rossi", 1, "Ada", who, PAGE),
         ("rossi", 2, "Other", who, PAGE.replace("Ada", "Later")), ("bianchi", 1, "B", who, "<p>no box</p>"), ("bianchi", 1, "B", who, None)],
        "surname string, rank long, title string, first_sentence string, html string")
    write_parquet(pages, str(tmp_path / "pages"))
    speeches = _speeches(spark)
    answers = speeches.select("speech", F.lit("2020-01-01$Rome").alias("response"), F.col("speech_id").alias("seq"))
    write_parquet(answers, str(tmp_path / "answers"))
    out = enrich(speeches, pages=read_pages(spark, str(tmp_path / "pages")),
                 responses=read_responses(spark, str(tmp_path / "answers")))
    rows = {r.surname: r for r in out.collect()}
    assert rows["rossi"].full_name == "Ada Example Rossi" and rows["rossi"].death_place == "Naples, Italy"
    assert rows["bianchi"].full_name is None and rows["verdi"].full_name is None
    assert {r.speech_location for r in rows.values()} == {"Rome"}


def test_models_in_enrichment(spark):  # M2, M3, M4, L7 inside Z1
    from oratio.operators import propaganda as P
    from oratio.plans.enrich import OUTPUT_COLUMNS, enrich

    def fixed(i, n):
        return lambda: (lambda texts: np.eye(n)[[i] * len(texts)])

    gate = M.Scorer(lambda: (lambda texts: np.array([[0.0, 1.0] if "End." in t else [1.0, 0.0] for t in texts])),
                    ["not", "propaganda"])
    out = enrich(_speeches(spark), sentiment=M.sentiment_scorer(fixed(0, 3)), emotion=M.emotion_scorer(fixed(1, len(M.EMOTION_LABELS))),
                 tone_lexicon=[("corrupt", 1.0)], propaganda=P.scorer_flag(gate))
    rows = {r.surname: r for r in out.collect()}
    assert out.columns == ["speech_id"] + OUTPUT_COLUMNS and len(rows) == 3
    assert {r.tone for r in rows.values()} == {"Informal"}
    assert {r.sentiment for r in rows.values()} == {M.SENTIMENT_LABELS[0].capitalize()}
    assert {r.emotion for r in rows.values()} == {M.EMOTION_LABELS[1].capitalize()}
    assert rows["bianchi"].propaganda_type == "Not propaganda"
    assert "Unspecified" in rows["verdi"].propaganda_type and "Unspecified" not in rows["rossi"].propaganda_type


def test_read_speeches_splittable(spark, tmp_path):  # S1 without line breaks in fields
    from oratio.sources.files import read_speeches

    p = tmp_path / "speech-c.tsv"
    p.write_text('Rossi\t1\tA speech\nBianchi\t0\t"two\twords"\n')
    for multi in (True, False):
        rows = read_speeches(spark, str(p), multi_line=multi).orderBy("speech_id").collect()
        assert [(r.surname, r.code, r.speech) for r in rows] == [("Rossi", 1, "A speech"), ("Bianchi", 0, "two\twords")]


def test_first_tag_text(spark):  # X4
    df = spark.createDataFrame([("<html><title>Hello</title></html>",), ("<p>x</p>",)], "h string")
    assert [r[0] for r in df.select(J.first_tag_text(F.col("h"), "title")).collect()] == ["Hello", ""]


def test_scorer_argmax_label(spark):  # c32
    scorer = M.Scorer(lambda: (lambda texts: np.array([[0.1, 0.7, 0.2]] * len(texts))), ["low", "mid", "high"])
    df = spark.createDataFrame([("a",), ("b",)], "speech string")
    assert [r.s for r in scorer.add(df, "speech", "s").collect()] == ["Mid", "Mid"]


def test_trained_classifier(spark):  # M6
    rows = [("you idiot loser", 1), ("stupid moron", 1), ("lovely day", 0), ("kind words", 0)] * 5
    df = spark.createDataFrame(rows, "speech string, toxic int")
    model = M.fit_text_classifier(df, "speech", "toxic", num_features=1 << 10, max_iter=20)
    out = M.label_from_model(model, df, "speech", ["not toxic", "toxic"], "label", "p").collect()
    assert {(r.speech, r.label) for r in out} >= {("you idiot loser", "Toxic"), ("lovely day", "Not toxic")}


def test_extract_with_callable(spark):  # M7
    df = spark.createDataFrame([(1, "Ada", "s1"), (2, "Ada", "s1"), (3, "Bo", "s2"), (4, "Bo", "s1"), (5, "Cy", "s1")],
                               "speech_id long, full_name string, speech string")

    def complete(name, speech):
        if name == "Bo":
            raise RuntimeError("rate limited")
        return f"2020-01-01${name}"

    for parts in (1, 2, 8):  # one text under three names, one call failing: the last answer in input order stays
        out = R.extract_with(df.repartition(parts), complete)
        rows = {(r.name, r.speech): r for r in out.collect()}
        assert len(rows) == 4 and rows["Bo", "s2"].error.startswith("RuntimeError") and rows["Ada", "s1"].seq == 2
        latest = {r.speech: r.response for r in R.latest_responses(R.usable_responses(out)).collect()}
        assert latest == {"s1": "2020-01-01$Cy"}


def test_mean_pool_and_zero(spark):  # c30
    df = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0])], "k long, v array<double>")
    assert E.pool_embeddings(df, "k", "v").first().v == [2.0, 4.0]
    ids = spark.createDataFrame([(1, "one two"), (2, "")], "speech_id long, speech string")
    emb = {r.speech_id: r.embedding for r in E.speech_embeddings(ids, "speech_id", "speech", dim=4).collect()}
    assert emb[2] == [0.0] * 4 and len(emb[1]) == 4


def test_project_2d(spark, sf_dir):  # E3
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    out = E.project_2d(e, "vec_id", "embedding")
    assert out.count() == e.count() and set(out.columns) == {"vec_id", "x", "y"}


def test_read_and_write_speeches(spark, tmp_path):  # c33, S2
    from oratio.sources.files import read_speeches, write_speeches

    p = tmp_path / "speech-a.tsv"
    p.write_text('Rossi\t1\tA "quoted"" speech\textra\nBianchi\t0\tN/A\nVerdi\t1.0\t"multi\nline"\n')
    rows = read_speeches(spark, str(p)).orderBy("speech_id").collect()
    assert [(r.surname, r.code) for r in rows] == [("Rossi", 1), ("Bianchi", 0), ("Verdi", 1)]
    assert rows[1].speech is None and rows[2].speech == "multi\nline"
    out = tmp_path / "out"
    df = spark.createDataFrame([(1, "a", 1, "", None)], "speech_id long, surname string, code int, speech string, tone string")
    write_speeches(df, str(out))
    lines = [ln for f in sorted(out.glob("part-*.csv")) for ln in f.read_text().splitlines()]
    assert lines[0] == "Surname,Code,Speech,Tone"
    assert [ln for ln in lines if not ln.startswith("Surname")] == ['a,1,"",']


def test_streaming_enrichment(spark, sf_dir, tmp_path):
    from oratio.plans.enrich import OUTPUT_COLUMNS
    from oratio.streaming.stream import enrich_stream, read_speech_stream

    src = tmp_path / "in"
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").select(
        F.col("doc_id").alias("speech_id"), F.col("source").alias("surname"), F.col("toxic").alias("code"),
        F.col("text").alias("speech"))
    raw.write.parquet(str(src))
    stream = enrich_stream(read_speech_stream(spark, str(src)))
    q = (stream.writeStream.format("memory").queryName("enriched_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM enriched_stream")
    assert got.columns == ["speech_id"] + OUTPUT_COLUMNS and got.count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert len(df.columns) == 32 and df.count() > 0
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 40


def test_enrichment_to_csv(spark, sf_dir, tmp_path):  # Z1 -> S2
    import csv

    from oratio.plans.enrich import OUTPUT, enrich_testdata
    from oratio.sources.files import write_speeches

    out = tmp_path / "speech-b"
    df = enrich_testdata(spark, sf_dir)
    write_speeches(df, str(out))
    rows = []
    for f in sorted(out.glob("part-*.csv")):
        with open(f, newline="") as fh:
            rows.extend(list(csv.reader(fh)))
    header = rows[0]
    assert header == [name for _, name in OUTPUT]
    data = [r for r in rows if r != header]
    assert len(data) == df.count() and all(len(r) == 31 for r in data)


def test_streaming_dedup_within_watermark(spark, tmp_path):
    from oratio.streaming.stream import enrich_stream, read_speech_stream

    text = "They are corrupt. " * 20
    rows = [(1, "a", 1, text, "2024-01-01 00:00:00"), (2, "a", 1, text, "2024-01-01 00:00:05"),
            (3, "b", 0, text + " Other.", "2024-01-01 00:00:07")]
    src = tmp_path / "in"
    spark.createDataFrame(rows, "speech_id long, surname string, code int, speech string, ts string") \
        .withColumn("ts", F.to_timestamp("ts")).write.parquet(str(src))
    schema = "speech_id bigint, surname string, code int, speech string, ts timestamp"
    stream = enrich_stream(read_speech_stream(spark, str(src), schema=schema), event_time="ts", watermark="1 hour")
    q = (stream.writeStream.format("memory").queryName("dedup_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT speech_id, propaganda_type FROM dedup_stream").collect()
    ids = sorted(r.speech_id for r in got)
    # one of the two copies survives (the first to arrive), the distinct speech is kept
    assert len(ids) == 2 and ids[0] in (1, 2) and ids[1] == 3
    assert {r.speech_id: r.propaganda_type for r in got}[ids[0]] == "Opposition distortion"


def test_toxic_model_query_runs_m5(spark, sf_dir, monkeypatch):
    from oratio.operators import models
    from oratio.plans import catalog

    calls, real = [], models.add_toxicity_model
    monkeypatch.setattr(models, "add_toxicity_model", lambda *a, **b: calls.append(1) or real(*a, **b))
    out = catalog.q_toxic_model(spark, sf_dir)
    assert calls and out.columns == ["doc_id", "toxicity", "p"]
    assert {r.toxicity for r in out.select("toxicity").distinct().collect()} <= {"Not toxic", "Toxic"}


def test_latest_response_of_ties_and_popular_texts(spark):  # J3
    rows = [("t", f"r{i}", i % 50) for i in range(3000)] + [("t", "x", 49), ("u", "only", None), ("u", "only", None), (None, "n", 1), ("", "e", 2)]
    resp = spark.createDataFrame(rows, "speech string, response string, seq long")
    got = [(r.speech, r.response) for r in R.latest_responses(resp).collect() if r.speech is not None]
    assert sorted(s for s, _ in got) == ["", "t"] and dict(got)["t"] in {r for s, r, q in rows if s == "t" and q == 49}
    again = [(r.speech, r.response) for r in R.latest_responses(resp.repartition(7)).collect() if r.speech is not None]
    assert sorted(got) == sorted(again)  # ties are decided by the response, not by the order
    sp = spark.createDataFrame([(1, "t"), (2, "t"), (3, "none"), (4, None)], "speech_id long, speech string").withColumn("seq", F.lit(0))
    out = R.add_responses(sp, R.latest_responses(resp))
    assert out.columns[:3] == ["speech_id", "speech", "seq"] and not any(c.startswith("__") for c in out.columns)
    assert {r.speech_id: r.fields_found for r in out.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


def test_response_join_sorts_no_texts(spark):  # J3: the best row of a key by numbers, before the shuffle and after it
    sp = spark.createDataFrame([(1, "t")], "speech_id long, speech string")
    resp = spark.createDataFrame([("t", "r", 1)], "speech string, response string, seq long")
    plan = R.add_responses(sp, R.latest_responses(resp))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2


def test_extract_missing_asks_new_and_failed_pairs_only(spark, tmp_path):  # M7
    log, store = str(tmp_path / "calls"), str(tmp_path / "store")

    def service(fails):
        def complete(name, speech):
            with open(log, "a") as f:
                f.write(f"{name}|{speech}\n")
            if speech in fails:
                raise RuntimeError("rate limited")
            return f"{speech} by {name}"
        return complete

    def run(rows, fails=()):
        open(log, "w").close()
        df = spark.createDataFrame(rows, "speech_id long, full_name string, speech string").repartition(3)
        out = R.extract_missing(df, store, service(fails))
        return out, sorted(open(log).read().splitlines())

    assert R.stored_answers(spark, store) is None
    rows = [(1, "Ada", "s1"), (2, "Ada", "s1"), (3, "Bo", "s2"), (4, None, "s3"), (5, "Cy", "s4")]
    _, calls = run(rows, {"s2", "s4"})
    assert calls == ["Ada|s1", "Bo|s2", "Cy|s4", "None|s3"]
    _, calls = run([*rows, (6, "Di", "s5")], {"s4"})
    assert calls == ["Bo|s2", "Cy|s4", "Di|s5"]
    out, calls = run([*rows, (6, "Di", "s5"), (7, "Ed", "s1")])
    assert calls == ["Cy|s4", "Ed|s1"]
    _, calls = run(rows)
    assert calls == []
    kept = {(r.name, r.speech): (r.response, r.generation) for r in out.where("error IS NULL").collect()}
    assert kept == {("Ada", "s1"): ("s1 by Ada", 0), (None, "s3"): ("s3 by None", 0), ("Bo", "s2"): ("s2 by Bo", 1),
                    ("Di", "s5"): ("s5 by Di", 1), ("Cy", "s4"): ("s4 by Cy", 2), ("Ed", "s1"): ("s1 by Ed", 2)}
    latest = {r.speech: r.response for r in R.latest_responses(R.usable_responses(out)).collect()}
    assert latest["s1"] == "s1 by Ed" and latest["s4"] == "s4 by Cy"  # the later generation, though of an older id
    (tmp_path / "store" / "generation=9").mkdir()  # a run that did not end
    assert R.stored_answers(spark, store).count() == out.count() and run([(8, "Fy", "s9")])[1] == ["Fy|s9"]


def test_hashed_chunk_embeddings(spark):  # E1 in SQL against plain Python; F8
    import hashlib

    texts = ["one two One", "", None, "café \u2003 x", " ".join(f"w{i % 90}" for i in range(1200))]
    df = spark.createDataFrame(list(enumerate(texts)), "speech_id long, speech string")

    def vector(words, dim):
        v = [0.0] * dim
        for w in words:
            c = int(hashlib.md5(w.lower().encode()).hexdigest()[:8], 16) % (2 * dim)
            v[c // 2] += (1 - 2 * (c % 2)) / len(words)
        return v
    for dim in (4, 64):
        got = {(r.speech_id, r.chunk_no): r.embedding for r in E.chunk_embeddings(df, "speech_id", "speech", dim=dim).collect()}
        want = {(i, k): vector(t.split()[s:s + 512], dim) for i, t in enumerate(texts) if t
                for k, s in enumerate(range(0, len(t.split()), 384))}
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    plan = E.speech_embeddings(df, "speech_id", "speech")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    pooled = {r.speech_id: r.embedding for r in E.speech_embeddings(df, "speech_id", "speech").collect()}
    assert pooled[1] == pooled[2] == [0.0] * 64


def test_word2vec_embeddings(spark):  # E1 with trained vectors: the mean of the words' vectors
    df = spark.createDataFrame([(i, ("sea ship wave " if i % 2 else "hill tree rock ") * 40) for i in range(20)] + [(20, "unknown"), (21, "")],
                               "speech_id long, speech string")
    model = E.fit_word2vec(df, "speech", dim=8, min_count=5, maxIter=2)
    vec = {r.word: np.array(r.vector) for r in model.getVectors().collect()}
    got = {r.speech_id: r.embedding for r in E.speech_embeddings(df, "speech_id", "speech", model, 8).collect()}
    assert np.allclose(got[1], sum(vec[w] for w in ("sea", "ship", "wave")) / 3, atol=1e-5)
    assert got[20] == got[21] == [0.0] * 8


def test_project_2d_equals_numpy(spark, sf_dir):  # E3
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    got = {r.vec_id: (r.x, r.y) for r in E.project_2d(rows, "vec_id", "embedding").collect()}
    data = rows.collect()
    v = np.array([r.embedding for r in data], dtype=float)
    _, vectors = np.linalg.eigh(np.cov(v.T))
    axes = vectors[:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    assert np.allclose([got[r.vec_id] for r in data], v @ axes, atol=1e-8)


def test_labels_of_a_model_equal_its_weights(spark):  # M1-M3: multi-class, recomputed from the exported weights
    rows = [(i, f"{w} {w} common word{i % 5}", lab) for i, (w, lab) in enumerate(
        [("joy", "joy"), ("rage", "anger"), ("tears", "sadness"), ("wow", "surprise")] * 15)] + [(90, None, "joy"), (91, "joy", None), (92, "", None)]
    df = spark.createDataFrame(rows, "id long, text string, lab string").withColumn("label", F.lit(0))
    m = M.fit_labels(df, "text", "lab", max_terms=3, num_features=1 << 10, max_iter=15)
    assert m.labels == ["anger", "joy", "sadness", "surprise"]
    tf, idf, lr = m.model.stages
    weights, bias, scale = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray(), idf.idf.toArray()
    out = m.score(df, "text", "said", "p").collect()
    for r in out:
        x = np.zeros(1 << 10)
        for t in [t for t in (r.text or "").lower().split() if len(t) > 1][:3]:  # the first three terms only
            x[tf.indexOf(t)] += 1
        z = weights @ (x * scale) + bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.said == m.labels[int(p.argmax())].capitalize() and abs(r.p - p.max()) < 1e-9
    assert {r.text.split()[0]: r.said for r in out if r.lab and r.text} == {
        "joy": "Joy", "rage": "Anger", "tears": "Sadness", "wow": "Surprise"}
    longer = spark.createDataFrame([(1, "joy joy joy rage rage rage rage rage")], "id long, text string")
    assert m.score(longer, "text", "said").first().said == "Joy"  # what lies behind the limit does not count
    with pytest.raises(ValueError):
        M.fit_labels(df.where("lab = 'joy'"), "text", "lab")


def test_score_text_query(spark, sf_dir):
    from oratio.plans import catalog

    out = catalog.q_score_text(spark, sf_dir)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.label for r in out.collect()}
    assert got.keys() == lang.keys()
    right = sum(got[i] == lang[i].capitalize() for i in got if lang[i])
    assert right / len(got) > 0.8


def test_fit_labels_keeps_hashed_counts_not_terms(spark, monkeypatch):  # M1-M3
    from oratio.operators import models

    kept = []
    cut = models.cut_lineage
    monkeypatch.setattr(models, "cut_lineage", lambda df: kept.append(dict(df.dtypes)) or cut(df))
    rows = [(i, f"{'red' if i % 2 else 'blue'} word{i % 7} text", "warm" if i % 2 else "cold") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = models.fit_labels(df, "text", "lang", num_features=1 << 8, max_iter=10)
    assert kept == [{"__tf": "vector", "__label": "double"}]
    assert {(r.lang, r.label) for r in model.score(df, "text", "label").collect()} == {("warm", "Warm"), ("cold", "Cold")}


def test_score_text_cuts_each_text_once(spark, sf_dir):  # M1-M3
    from oratio.operators import models
    from oratio.plans import catalog

    out = catalog.q_score_text(spark, sf_dir)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # scoring reads the counts that the fit was made of
    t = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    want = models.fit_labels(t, "text", "lang").score(t, "text", "label", "p")
    got = {r.doc_id: (r.label, r.p) for r in out.collect()}
    assert len(got) == t.count()
    for r in want.collect():
        assert got[r.doc_id][0] == r.label and abs(got[r.doc_id][1] - r.p) < 1e-5


def test_first_terms_of_long_texts(spark):  # M1-M3
    from oratio.functions import text as T
    from oratio.operators import models

    texts = [None, "", "ab " * 3, "ab cd ef gh", "x " * 200 + "late terms at the very end", "word\u03a3 " * 30, "aa bb cc" + "d" * 90,
             "\u0130\u0130 " * 20, "ab " * 7 + "- " * 50 + "cd", "a" * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for n in (1, 3, 7, 8, 40):
        got = df.select("id", models.first_terms("text", n, 2).alias("got"), T.terms("text").alias("all"))
        assert "substring" in got._jdf.queryExecution().optimizedPlan().toString()  # not the whole of every text
        for r in got.collect():
            assert r.got == (r.all or [])[:n], (n, r)


def test_counts_of_one_file_are_dealt_over_tasks(spark, monkeypatch):  # M1-M3
    from oratio.operators import models

    monkeypatch.setattr(models, "SPLIT", 64 << 10)
    block = spark.conf.get("parquet.block.size", None)
    df = spark.range(6000).coalesce(1).selectExpr("id", "concat_ws(' ', transform(sequence(1, 20), i -> hex(hash(id, i)))) AS text",
                                                  "IF(id % 2 = 0, 'even', 'odd') AS lang")
    sizes, fit = [], models._fit

    def seen(train, *rest):
        with models._split(spark):
            sizes.extend(r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect())
        return fit(train, *rest)

    monkeypatch.setattr(models, "_fit", seen)
    counts = models.stored_counts(df, "text", 32, 1 << 10)
    models.fit_counts(counts, "lang", 32, 1 << 10, 2)
    assert sum(sizes) == 6000 and max(sizes) <= 2000
    assert spark.conf.get("parquet.block.size", None) == block


def test_stored_counts_lie_by_label(spark, monkeypatch):  # M1-M3
    from oratio.operators import models

    rows = spark.range(0, 400, 1, 3).selectExpr(
        "id", "concat_ws(' ', 'term', hex(hash(id))) AS text", "IF(id % 7 = 0, NULL, concat('l', id % 4)) AS lang")
    kept, cut = [], models.cut_lineage
    monkeypatch.setattr(models, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    counts = models.stored_counts(rows, "text", 8, 1 << 8, "lang")
    models.fit_labels(rows, "text", "lang", 8, 1 << 8, 2)
    assert sorted(r.id for r in counts.collect()) == list(range(400))
    for df, label in zip(kept, ("lang", "__label"), strict=True):
        files = {}
        for r in df.select(F.input_file_name().alias("file"), label).collect():
            files.setdefault(r.file, []).append((r[label] is not None, r[label]))
        assert len(files) == 3 and all(x == sorted(x) for x in files.values())
