"""The thin queries of the training-data operators over the driver tables, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SQL_GAP, let_sql, table
from . import (chat_format, fm_dedup, hyperminhash, mixing, nn_descent, packing, periodic_runs, quality_rules, simhash,
               token_file, toxicity, turn_repair, url_filter)
from .tokens import default_path

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op1(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.toxicity(docs, labels).drop("text")


def op2(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality_rules.quality_rules(docs)
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rest = [n for n in quality_rules.STATS if n not in first]
    return q.select("doc_id", *[F.col(f"quality.{n}") for n in first + rest])


def op2_sql() -> str:
    ws = r"[\x20\x09-\x0D]+"
    stops = ", ".join(f"'{f}'" for s in quality_rules.STOP_WORDS for f in (s, s.capitalize()))
    tests = []
    for r in quality_rules.RULES:
        v = f"(CASE WHEN {r.per} > 0 THEN {r.value} / {r.per} ELSE 0 END)" if r.per else r.value
        tests += [f"{v} >= {r.least}"] * (r.least is not None) + [f"{v} <= {r.most}"] * (r.most is not None)
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, x, list_filter(string_split_regex(x, '{ws}'), lambda a: a <> '') AS w,
      list_filter(string_split(x, chr(10)), lambda a: regexp_matches(a, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
s AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(list_intersect(list_distinct(w), [{stops}])) AS BIGINT) AS n_stop_words,
  CAST(len(list_filter(l, lambda a: regexp_matches(a, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS BIGINT) AS n_elliptic_lines,
  CAST(len(list_filter(l, lambda a: regexp_matches(a, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS BIGINT) AS n_bullet_lines
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND {' AND '.join(tests)} AS kept FROM b"""


def op3(spark, sf_dir) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.expr("id % 100 = 0"))


def op4(spark, sf_dir) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_file.write_token_file(docs, token_file.fresh_path(spark), default_path(), end_id=2)
    return token_file.read_token_file(spark, path, with_ids=False)


def op6(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target",
                                   (F.col("copies") * F.col("size")).alias("taken"))


def op7(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digest(packing.pack(docs, default_path(), end_id=1))


def op8(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = rows.sparkSession.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                              "conv_id long, turn long, role string, text string")
    path = default_path()
    return chat_format.read_back(chat_format.assemble(rows.unionByName(extra), path), path)


def op9(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


def op10(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fm_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_sql() -> str:
    return r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda a: a <> '') AS w
      FROM documents),
g AS (SELECT doc_id, i, hash(w[i : i + 12]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
l AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM g),
c AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM l WHERE least < doc_id) GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w) AS n, coalesce(len(p), 0) AS r,
      list_filter(w, lambda x, i: NOT coalesce(list_contains(p, i), false)) AS kept FROM w LEFT JOIN c ON w.doc_id = c.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""


def op9_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""WITH r(rh, rp, act) AS (VALUES {rules}),
u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS s
      FROM pages),
p AS (SELECT page_id, translate(regexp_extract(s, '(?s)^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
      regexp_extract(s, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
d AS (SELECT DISTINCT host, path FROM p),
m AS (SELECT host, path, arg_max(rh || rp, length(rh) + length(rp)) AS rule, arg_max(act, length(rh) + length(rp)) AS act
      FROM d JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.act, 'allow') AS verdict FROM p LEFT JOIN m USING (host, path)"""


def with_periodic_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` in which texts chosen by a checksum of their id go on periodically from some word (a null id: unchanged)."""
    words = f"filter(split(coalesce({text}, ''), '{SQL_GAP}'), x -> x <> '')"
    at = "CAST(g % size(w) AS INT)"
    body = "array_join(transform(w, (x, i) -> CASE WHEN i < s.a THEN x ELSE get(w, CAST(s.a + (i - s.a) % s.p AS INT)) END), ' ')"
    step = f"named_struct('a', {at}, 'p', 1 + (size(w) - {at}) DIV (3 + g % 8))"
    tail = let_sql(words, "w", f"CASE WHEN size(w) > 0 THEN {let_sql(step, 's', body)} END")
    damaged = let_sql(f"crc32(CAST({key} AS STRING)) DIV 10", "g", tail)
    return docs.withColumn(text, F.expr(f"CASE WHEN crc32(CAST({key} AS STRING)) % 10 = 0 THEN {damaged} ELSE {text} END"))


def op11(spark, sf_dir) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.add_runs(docs).select("doc_id", "repetition.runs", "repetition.collapsed")
    best = F.expr("""aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) ->
        CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"), 256)
        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def crc32_sql(key: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string; needs the column ``crc_table`` in scope."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({key}, ''), "
            f"lambda c: ord(c)::BIGINT)), lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])))")


# The table of CRC-32 by its rule (reflected polynomial), as a common table expression.
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_table)"""


def op11_sql() -> str:
    """Pairs of equal 16-word windows at distance q, in stretches: every run of 24 words and 3 periods has such windows."""
    return rf"""WITH {CRC_TABLE_SQL},
h AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w,
      {crc32_sql("doc_id::VARCHAR")} AS h FROM documents, crc),
p AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS hit, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM h),
d AS (SELECT doc_id, CASE WHEN hit THEN list_transform(w, lambda x, i: CASE WHEN i - 1 < a THEN x
      ELSE w[a + (i - 1 - a) % (1 + (len(w) - a) // (3 + g % 8)) + 1] END) ELSE w END AS w FROM p),
x AS (SELECT doc_id, i, hash(w[i + 1 : i + 16]) AS k, len(w) AS n FROM (SELECT doc_id, w, unnest(range(0, len(w) - 15)) AS i FROM d)),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM x JOIN x y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i
      AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
m AS (SELECT doc_id, q, min(i) AS start, max(i) + 16 + q - min(i) AS length FROM s GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM m WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
      FROM r GROUP BY doc_id),
t AS (SELECT DISTINCT ON (doc_id) doc_id, start, length, period FROM r ORDER BY doc_id, length / period DESC, start, period),
c AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n_runs, 0) AS n_runs, t.start, t.length, t.period, 1000 * t.length // t.period AS exponent_milli,
  sha256(coalesce(b.t, '')) AS runs_sha256,
  sha256(array_to_string(list_filter(d.w, lambda x, i: NOT coalesce(list_contains(c.gone, i - 1), false)), ' ')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)"""


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Conversation rows damaged by a checksum of conversation and turn: dropped, emptied, without ``.!?``, twice, or by user."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    how = F.col("how")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("how")).where("how <> 0").select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(how == 3, 2).otherwise(1).alias("times")).select(
        "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times")).alias("copy")).drop("copy")


def op12(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = turn_repair.repair(damaged_conversations(rows))
    told = turn_repair.report(repaired).join(turn_repair.digests(repaired).withColumnRenamed("conv", "c"),
                                             F.col("conv").eqNullSafe(F.col("c")), "left")
    every = rows.select("conv_id").distinct()
    numbers = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(told, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_sql() -> str:
    """A table of the cheapest (cost, audit) of each state, row by row: an independent form of the search."""
    def least(*options):
        return f"list_sort([{', '.join(options)}])[1]"

    def step(state, cost, label):
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{label}'}}"
    never = "{'c': 1000000000, 'a': ''}"

    def when(cond, value):
        return f"CASE WHEN {cond} THEN {value} ELSE {never} END"
    stays = "NOT x.gone"
    extra = "5 * x.cut::INT"
    keeps = {(0, 1): "s", (0, 2): "u", (1, 2): "u", (3, 2): "u", (2, 3): "a"}
    cols = []
    for to in range(4):
        options = [step(f"d.s{to}", 2, "D")]
        for at in range(4):
            if (at, to) in keeps:
                options.append(when(f"{stays} AND x.i = '{keeps[at, to]}'", step(f"d.s{at}", extra, "K")))
            if (to == 2 and at != 2) or (to == 3 and at == 2):
                options.append(when(stays, step(f"d.s{at}", f"1 + {extra}", "R")))
        cols.append(f"{least(*options)} AS t{to}")
    two = least("t2", step("t0", 5, "I"), step("t1", 5, "I"), step("t3", 5, "I"))
    close = f"t0 AS s0, t1 AS s1, {two} AS s2, {least('t3', step(two, 5, 'I'))} AS s3"
    blank = r"NOT regexp_matches(text, '[^\x20\x09-\x0D]')"
    return rf"""WITH RECURSIVE {CRC_TABLE_SQL},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS how FROM conversations, crc),
r AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE WHEN how = 1 THEN ''
      WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END))
      FROM k WHERE how <> 0),
n AS (SELECT conv_id, turn, role, text, role[1] AS i,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM r),
f AS (SELECT *, CASE WHEN {blank} THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'd'
      WHEN regexp_matches(text, '[.!?][ 	-
]*$') THEN '-' ELSE 't' END AS fault,
      lag(i) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM n),
x AS (SELECT conv_id, rn, i, fault IN ('b', 'd') AS gone, fault = 't' AS cut FROM f),
v AS (SELECT DISTINCT conv_id FROM conversations),
d(conv_id, rn, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, {never}, {{'c': 5, 'a': 'I'}}, {{'c': 10, 'a': 'II'}} FROM v
  UNION ALL
  SELECT conv_id, rn, {close} FROM (SELECT d.conv_id, x.rn, {', '.join(cols)} FROM d JOIN x ON x.conv_id IS NOT DISTINCT FROM d.conv_id
  AND x.rn = d.rn + 1)),
b AS (SELECT conv_id, {least('s0', 's3')} AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) AS z FROM d)
      WHERE z = 1),
e AS (SELECT conv_id, pos, audit[pos] AS edit, pos - len(replace(audit[1:pos], 'I', '')) AS inserted,
      len(replace(audit[1:pos], 'D', '')) AS kept, audit FROM (SELECT conv_id, best.a AS audit, unnest(range(1, len(best.a) + 1)) AS pos FROM b)),
w AS (SELECT e.conv_id, e.pos, e.edit, e.kept, f.role, f.text, max(CASE WHEN e.edit = 'K' AND f.role[1] = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY e.conv_id) AS sys
      FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.rn = e.pos - e.inserted AND e.edit <> 'I'),
p AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (kept - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
      coalesce(CASE WHEN edit <> 'I' THEN text END, ''), chr(10) ORDER BY pos) AS t FROM w WHERE edit <> 'D' GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank,
      count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
      count_if(before IS NOT NULL AND (before || i) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT v.conv_id, {', '.join(f'CAST(coalesce(c.{z}, 0) AS BIGINT) AS {z}' for z in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
  CAST(b.best.c AS BIGINT) AS cost, b.best.a AS audit, sha256(coalesce(p.t, '')) AS repaired_sha256
FROM v JOIN b ON b.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM v.conv_id"""


def op13(spark, sf_dir) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_sql() -> str:
    """Equal sets collapse, a prefix of each set in hash order finds candidates, whole sets confirm, labels spread."""
    return r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END
      AS g FROM w),
k AS (SELECT doc_id, len(g) AS n, CASE WHEN len(g) > 0 THEN md5(array_to_string(list_sort(g), chr(10))) END AS k, g FROM g),
r AS (SELECT k, min(doc_id) AS id, any_value(n) AS n, any_value(g) AS g FROM k WHERE k IS NOT NULL GROUP BY k),
s AS (SELECT id, n, unnest(g) AS g FROM r),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hash(g), g) AS pos FROM s)
      WHERE pos <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.id AS u, b.id AS v, a.n AS nu, b.n AS nv FROM p a JOIN p b ON a.g = b.g AND a.id < b.id
      AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
o AS (SELECT u, v, nu, nv, count(*) AS common FROM c JOIN s a ON a.id = u JOIN s b ON b.id = v AND b.g = a.g GROUP BY u, v, nu, nv),
e AS (SELECT u, v FROM o WHERE 100 * common >= 80 * (nu + nv - common)),
l AS (SELECT id AS node, id AS root FROM r UNION
      SELECT x.v, l.root FROM l JOIN (SELECT u, v FROM e UNION ALL SELECT v, u FROM e) x ON x.u = l.node AND l.root < x.v),
m AS (SELECT node, min(root) AS root FROM l GROUP BY node)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(m.root, k.doc_id) AS component_id,
  k.doc_id = coalesce(m.root, k.doc_id) AS kept FROM k LEFT JOIN r USING (k) LEFT JOIN m ON m.node = r.id"""


QUERIES: dict[str, Callable] = {
    "op1_toxicity": op1,
    "op2_quality_rules": op2,
    "op3_nn_descent": op3,
    "op4_simhash": op4,
    "op5_token_file": op5,
    "op6_mixing": op6,
    "op7_packing": op7,
    "op8_chat_format": op8,
    "op9_url_filter": op9,
    "op10_fm_dedup": op10,
    "op11_periodic_runs": op11,
    "op12_turn_repair": op12,
    "op13_hyperminhash": op13,
}

ORACLE: dict[str, Callable[[], str]] = {
    "op2_quality_rules": op2_sql,
    "op9_url_filter": op9_sql,
    "op10_fm_dedup": op10_sql,
    "op11_periodic_runs": op11_sql,
    "op12_turn_repair": op12_sql,
    "op13_hyperminhash": op13_sql,
}
