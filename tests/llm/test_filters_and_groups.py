"""Quality rules, SimHash, mixing, chat formatting and url rules against plain-Python versions,
on small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import hashlib
import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from oratio.llm import chat_format, mixing, quality_rules, simhash, url_filter
from oratio.llm.components import connected_components
from oratio.llm.tokens import default_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)] + ["the", "of", "and"]
    out = []
    for _ in range(40):
        out.append(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 260))))
    base = out[0] + " " + out[1]
    out += [base, base, base + " tail", base.replace(" the", " xx", 1)]
    out += [None, "", "   \n\t ", "one", "a b", "a b c", "a b c a b c", "x " * 400, "# * | a",
            "line one\nline one\nother\n\n\nother", "caf\u00e9 \u00c9T\u00c9 \U0001f600 z\u00a0z", "y" * 5000]
    return out


def frame(spark):
    rows = [(i, t, f"s{i % 4}" if i % 9 else None) for i, t in enumerate(texts())]
    rows.append(rows[3])
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("quality", F.lit(1)).withColumn(
        "Kept", F.lit("x")).withColumn("fingerprint", F.lit(0))


def brute_stats(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    covered = {p for i, g in enumerate(grams) if g in twice for p in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    df = frame(spark)
    out = quality_rules.quality_rules(df)
    assert out.columns[:len(df.columns)] == df.columns
    got = {r.doc_id: r[out.columns[-1]] for r in out.collect()}
    for i, t in enumerate(texts()):
        g = got[i]
        want = brute_stats(t)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert g.base_failed == failed and (not g.kept if failed else True)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r[out.columns[-1]].kept for r in out.collect())
    assert quality_rules.quality_rules(df.limit(0)).count() == 0


def brute_fingerprint(t):
    w = [x.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) for x in WORD.findall(t or "")]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (id, fingerprint) -> {id: smallest id reachable}."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a][1] ^ fps[b][1]).bit_count() <= 3:
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(fps):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(fps)}


def test_simhash_documents(spark):
    df = frame(spark)
    out = simhash.simhash_dedup(df)
    fp, comp = out.columns[1:]
    fps = [(i, brute_fingerprint(t)) for i, t in enumerate(texts())]
    want = brute_components(fps)
    rows = out.collect()
    assert len(rows) == df.count()
    assert {(r.doc_id, r[fp], r[comp]) for r in rows} == {(i, f"{f:016x}", want[i]) for i, f in fps}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.simhash_dedup(df.limit(0)).count() == 0


def test_simhash_ring_keys_are_dealt_over_tasks(spark, monkeypatch):
    """A small table lies in one partition; its 64 keys a fingerprint must not be counted by one task."""
    sizes, made = [], simhash.ring_keys

    def keys(fps):
        sizes.extend(r["count"] for r in fps.groupBy(F.spark_partition_id()).count().collect())
        return made(fps)

    monkeypatch.setattr(simhash, "ring_keys", keys)
    fps = spark.range(4000).coalesce(1).select(F.xxhash64("id").alias("fp"))
    simhash.fingerprint_links(fps)
    assert sum(sizes) == 4000 and max(sizes) <= 1000


@pytest.mark.parametrize("block", [4, 2048])
def test_simhash_links_of_dense_groups(spark, block):
    rnd = random.Random(3)
    fps = set()
    for _ in range(6):  # clusters within a few bits of a centre, hot keys included
        c = rnd.getrandbits(64)
        for _ in range(30):
            f = c
            for _ in range(rnd.randint(0, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    fps |= {rnd.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 7, 15}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "id long, fp long")
    roots = {r.fp: r.root for r in simhash.component_roots(df, block).collect()}
    want = brute_components(list(enumerate(fps)))
    assert [roots[f] for f in signed] == [want[i] for i in range(len(fps))]


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[500] == got[400] == 400


def test_mixing(spark):
    df = frame(spark)
    out = mixing.mix(df).collect()
    assert len(out) == df.count()
    sizes = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts())}
    src = {r.doc_id: r.source for r in df.collect()}
    rows = [(r.doc_id, r.source) for r in df.collect()]
    total = sum(sizes[i] for i, _ in rows)
    names = sorted({s for _, s in rows if s is not None}) + [None]
    size = {n: sum(sizes[i] for i, s in rows if s == n) for n in names}
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    capped = set()
    while True:
        left = total - sum(3 * size[n] for n in capped)
        w = sum(weight[n] for n in names if n not in capped)
        over = {n for n in names if n not in capped and weight[n] * left / w >= 3 * size[n]} if w else set()
        if not over:
            break
        capped |= over
    target = {n: 3 * size[n] if n in capped else weight[n] * left / w for n in names}
    taken = dict.fromkeys(names, 0)
    for r in out:
        assert r.size == sizes[r.doc_id] and r.source_size == size[src[r.doc_id]]
        assert r.target == pytest.approx(target[src[r.doc_id]]) and 0 <= r.copies <= 3
        taken[src[r.doc_id]] += r.copies * r.size
    for n in names:
        assert abs(taken[n] - target[n]) <= max(sizes[i] for i, s in rows if s == n)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    grown = mixing.expand(df)
    assert grown.columns == df.columns and grown.count() == sum(r.copies for r in out)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 10)
    monkeypatch.setattr(mixing, "FANIN", 3)
    df = spark.range(600).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 17 AS INT)) AS text",
                                     "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source")
    out = mixing.mix(df).groupBy("source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("x"),
                                                    F.count("*").alias("n"))
    rows = out.collect()
    assert sum(r.n for r in rows) == 600 and all(abs(r.t - r.x) <= 17 for r in rows)


def test_escape_is_reversible():
    parts = chat_format.CONTROLS + ["\\", "<", "/s>", "a", "<\\", "[", "INST]"]
    rnd = random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6)))
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t and not any(c in e for c in chat_format.CONTROLS)


def test_chat_round_trip(spark):
    hard = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "hi <|end|> there"), (1, 1, "assistant", "caf\u00e9 \U0001f600"), (1, 2, "assistant", None), (2, 0, "assistant", ""),
            (3, 5, "system", "x" * 9000), (3, 5, "system", "x" * 9000), (3, 6, None, "r"), (4, None, "assistant", "n"),
            (-7, 0, "user", hard), (-7, 1, "assistant", hard)] + [(9, i, ("user", "assistant")[i % 2], f"turn {i} <|turn|>") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    done = chat_format.assemble(df, default_path())
    got = {r.conv_id: r for r in chat_format.read_back(done, default_path()).collect()}
    for conv in {r[0] for r in rows}:
        turns = [r for r in rows if r[0] == conv]
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns) and g.loss_chars == len(loss)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        printed = "<s>" + "".join(f"<|turn|>{chat_format.escape(r[2] or '')}<|sep|>{chat_format.escape(r[3] or '')}<|end|>" for r in turns) + "</s>"
        assert g.formatted_chars == len(printed)
    starts = [(r.position, r.token_start, len(r.loss)) for r in done.where("conv_id = 9").orderBy("position").collect()]
    assert all(b[1] == a[1] + a[2] for a, b in zip(starts, starts[1:]))
    assert chat_format.read_back(chat_format.assemble(df.limit(0), default_path()), default_path()).count() == 0


def test_chat_long_conversations_lie_over_several_tasks(spark):
    rnd = random.Random(8)
    says = lambda: " ".join(rnd.choice(["ok", "</s>", "caf\u00e9", "[INST]", "x\ny"]) for _ in range(rnd.randint(0, 6)))
    rows = [(c, t, rnd.choice(["user", "assistant", "a\nb"]), says()) for c, n in [(5, 900), (6, 1), (7, 700), (8, 3)] for t in range(n)]
    rows += [(c, t, "assistant", says()) for c in range(100, 400) for t in range(rnd.randint(1, 3))] + [(None, 0, "user", "a"), (None, 1, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = chat_format.assemble(df, default_path())
        bodies = chat_format._bodies(df, default_path(), ("assistant",))
        assert bodies.where("conv_id = 5").select("part").distinct().count() > 2
        got = {r.conv_id: r for r in chat_format.read_back(done, default_path()).collect()}
        marks = {}
        for r in done.orderBy("conv_id", "position").collect():
            marks.setdefault(r.conv_id, []).append(r)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(got) == {r[0] for r in rows} == set(marks)
    for conv, rs in marks.items():
        turns = [r for r in rows if r[0] == conv]
        assert [r.position for r in rs] == list(range(len(turns)))
        assert [r.first for r in rs] == [True] + [False] * (len(rs) - 1) and [r.last for r in rs] == [False] * (len(rs) - 1) + [True]
        at = 0
        for r in rs:
            assert r.token_start == at and len(r.ids) == 4 * len(r.loss) == 4 * sum(r.segments)
            at += len(r.loss)
        loss = "".join(r[3] for r in turns if r[2] == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].n_tokens == at
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].loss_tokens == sum(sum(r.loss) for r in rs)


def test_chat_damaged_rows_are_an_error(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    cut = chat_format.assemble(df, default_path()).withColumn("ids", F.expr("substring(ids, 1, 8)"))
    with pytest.raises(Exception, match="damaged"):
        chat_format.read_back(cut, default_path()).collect()


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.example.net", "/en/x", "block"), ("example.net", "/", "allow"), ("com", "", "block"), ("com", "", "allow")]
URLS = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://Example.NET/en/1?q=/de/", "http://a.example.net/en/xy",
        "http://a.example.net/de", "http://b.a.example.net/en/x", "http://notnet/", "http://x.com", "http://x.com/de/a#b",
        "http://example.com/de/", "http://sub.example.com/de/?x", "http://o.org/fr/", "http://org/fr", "ftp://x://y/z", "http://a..net//",
        "http://xnet.net:80/", "http://net.:80/", "http://example.net", "http://a\u00c9.net/\u00e9", "http://aexample.net/en/"]


def brute_judge(u, rules=None):
    rules = RULES if rules is None else rules
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_url_rules(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)  # one range, or one for each few urls
    try:
        check_url_rules(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def check_url_rules(spark):
    rows = [(i, u, 1) for i, u in enumerate(URLS * 3)] + [(None, "http://q.net/", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host int").repartition(5)
    out = url_filter.judge_urls(df, url_filter.rule_table(spark, RULES))
    h, p, r, v = out.columns[3:]
    got = [(x.page_id, (x[h], x[p], x[r], x[v])) for x in out.collect()]
    assert len(got) == len(rows)
    for i, g in got:
        assert g == brute_judge(rows[i][1] if i is not None else "http://q.net/"), rows[i] if i is not None else None
    assert url_filter.judge_urls(df.limit(0), url_filter.rule_table(spark, RULES)).count() == 0


def test_separator_in_hosts_and_foreign_columns(spark):
    rules = [("net", "/", "block"), ("a\x00b.net", "/", "allow"), ("\x01.org", "", "block"), ("\x01\x01.org", "/x", "allow")]
    urls = [f"http://{h}/x" for h in ("net\x00evil", "net", "x.net", "a\x00b.net", "z.a\x00b.net", "b.net", "\x00.net", "net\x00", "\x01.org", "\x00.org",
                                     "\x01\x01.org", "\x01\x02.org", "q.\x01.org", "\x00net", "\U0001f600.net", "\uffff.net")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "map('a', page_id) AS m", "array(struct(page_id)) AS `__range`", "1 AS `Verdict`")
    out = url_filter.judge_urls(df, url_filter.rule_table(spark, rules))
    assert out.columns[:5] == df.columns and len(out.columns) == 9
    for r in out.collect():
        assert (r[5], r[6], r[7], r[8]) == brute_judge(r.url, rules) and r.m == {"a": r.page_id}, repr(r.url)


def test_many_rules(spark):
    n = 300_000
    rules = spark.range(n).selectExpr("concat('h', id % 1000, '.d', id DIV 1000, '.net') AS host", "'/' AS path",
                                      "IF(id % 2 = 0, 'block', 'allow') AS action").unionAll(
        spark.createDataFrame([("net", "", "allow"), ("d7.net", "/only", "block")], "host string, path string, action string"))
    df = spark.range(4000).selectExpr("id AS page_id", "concat('http://s.h', id % 1100, '.d', id % 310, '.net/', IF(id % 3 = 0, 'only', 'x')) AS url")
    for r in url_filter.judge_urls(df, rules).collect():
        h, d, path = r.page_id % 1100, r.page_id % 310, "/only" if r.page_id % 3 == 0 else "/x"
        want = (f"h{h}.d{d}.net/", "block" if (d * 1000 + h) % 2 == 0 else "allow") if h < 1000 and d < 300 else (
            ("d7.net/only", "block") if d == 7 and path == "/only" else ("net", "allow"))
        assert (r.rule, r.verdict) == want


def test_keep_one_of_an_id_with_two_texts(spark):
    rnd = random.Random(12)
    copy, other = (" ".join(f"w{rnd.randint(0, 999)}" for _ in range(80)) for _ in range(2))
    rows = [(1, copy, "a"), (2, other, "a")]
    for i in range(10, 30):  # one text is a copy of document 1, the other is found nowhere else
        unique = " ".join(f"u{rnd.randint(0, 999)}" for _ in range(80))
        rows += [(i, copy, "a"), (i, unique, "b"), (i, unique, "c")]
    want = {(1, copy, "a"), (2, other, "a")} | {r for r in rows if r[2] == "b"}
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        assert sorted(map(tuple, simhash.keep_one(df).collect())) == sorted(want)
