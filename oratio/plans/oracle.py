"""DuckDB SQL forms of the registered queries (the correctness oracle).

Same token patterns (RE2 spellings from ``functions.text``), vowel rule, lexicons, output columns
and types as the Spark code: a check of the plans and functions, not of those definitions. The
plain-Python tests in ``tests/`` are the second opinion on the definitions.
Tables ``documents``, ``labels``, ``pages``, ``embeddings`` … are views in the oracle session.
"""

from __future__ import annotations

from collections.abc import Callable

from ..functions import text as T
from ..functions.lexicons import (CHUNK_OVERLAP, CHUNK_SIZE, NOT_SUPERLATIVE, PERSUASION, PERSUASION_WEIGHTS,
                                  POLITICIAN_KEYWORDS, PROBE, PROBE_TONE, PROPAGANDA, SUPERLATIVE_WORDS,
                                  TOP_KEYWORDS, TOP_TYPES, TOXICITY, stop_words)

q = T.sql_str
NL = "chr(10)"
STEP = CHUNK_SIZE - CHUNK_OVERLAP
SUMMARY_WORDS = 100


def in_list(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def title_literal(key: str) -> str:
    return " ".join(w[:1].upper() + w[1:].lower() for w in key.replace("_", " ").split(" "))


def hits_sql(lc: str, lexicon) -> list[str]:
    return ["(" + " + ".join(f"CAST(contains({lc}, {q(p)}) AS INTEGER)" for p in ps) + ")" for _, ps in lexicon]


def predominant_sql(hits: list[str], lexicon) -> str:
    top = f"greatest({', '.join(hits)})"
    whens = " ".join(f"WHEN {h} = {top} AND {h} > 0 THEN {q(c)}" for (c, _), h in zip(lexicon, hits))
    return f"CASE {whens} END"


def any_phrase_sql(lc: str, lexicon) -> str:
    return "(" + " OR ".join(f"contains({lc}, {q(p)})" for _, ps in lexicon for p in ps) + ")"


RAW = ("raw AS (SELECT d.doc_id AS speech_id, d.source AS surname, l.toxic AS code, d.text AS speech "
       "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
COMPLETE = "complete AS (SELECT * FROM raw WHERE surname IS NOT NULL AND code IS NOT NULL AND speech IS NOT NULL)"
USABLE = (f"usable AS (SELECT speech_id, surname, code, speech FROM ("
          f"SELECT speech_id, surname, code, {T.duck_remove_links('speech')} AS speech FROM ("
          f"SELECT min(speech_id) AS speech_id, surname, code, speech FROM complete GROUP BY surname, code, speech)) "
          f"WHERE length(speech) >= 200 AND code IN (0, 1))")
BASE = f"WITH {RAW}, {COMPLETE}, {USABLE}"


def _syl(x: str) -> str:
    lx = f"lower({x})"
    v = f"len(regexp_extract_all({lx}, '{T.VOWELS}'))"
    silent = f"({v} > 1 AND regexp_matches({lx}, '[^aeiouy]e$') AND NOT regexp_matches({lx}, '[^aeiouy]le$'))"
    return f"greatest(1, {v} - CAST({silent} AS INTEGER))"


def _ordinal(n: str) -> str:
    return (f"(CAST({n} AS VARCHAR) || CASE WHEN ({n}) % 100 IN (11, 12, 13) THEN 'th' WHEN ({n}) % 10 = 1 THEN 'st' "
            f"WHEN ({n}) % 10 = 2 THEN 'nd' WHEN ({n}) % 10 = 3 THEN 'rd' ELSE 'th' END)")


# ---- search (shared by the propaganda queries) -----------------------------------------------

def _findings_ctes(lexicon, routed: bool, flag: str | None = None) -> str:
    """``flag``: SQL of a rule in the classifier's place, ``{text}`` standing for the text (M4)."""
    hits = hits_sql("ls", lexicon)
    where = "WHERE code = 1" if routed else ""
    gate = f" OR {flag.format(text='chunk')}" if flag else ""
    typed = predominant_sql([f'h{i}' for i in range(len(lexicon))], lexicon)
    if flag:
        typed = f"coalesce({typed}, CASE WHEN {flag.format(text='sentence')} THEN 'Unspecified' END)"
    return f"""{BASE},
sp AS (SELECT speech_id, code, speech FROM usable {where}),
ww AS (SELECT speech_id, {T.duck_words('speech')} AS w FROM sp),
st AS (SELECT speech_id, w, unnest(generate_series(0, len(w) - 1, {STEP})) AS st FROM ww WHERE len(w) > 0),
ch AS (SELECT speech_id, st // {STEP} AS chunk_no, array_to_string(w[st + 1 : st + {CHUNK_SIZE}], ' ') AS chunk FROM st),
chk AS (SELECT * FROM ch WHERE {any_phrase_sql('lower(chunk)', lexicon)}{gate}),
ss AS (SELECT speech_id, chunk_no, {T.duck_sentences('chunk')} AS ss FROM chk),
se AS (SELECT speech_id, chunk_no, unnest(ss) AS sentence, unnest(range(len(ss))) AS sent_no FROM ss),
hs AS (SELECT speech_id, chunk_no, sent_no, sentence, {', '.join(f'{h} AS h{i}' for i, h in enumerate(hits))}
       FROM (SELECT *, lower(sentence) AS ls FROM se)),
fd AS (SELECT speech_id, chunk_no, sent_no, sentence,
       {typed} AS type FROM hs),
fo AS (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY chunk_no, sent_no) - 1 AS ord
       FROM fd WHERE type IS NOT NULL),
tc AS (SELECT speech_id, type, count(*) AS n, min(ord) AS first_seen FROM fo GROUP BY speech_id, type),
tt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY n DESC, first_seen) AS rank
       FROM tc) WHERE rank <= {TOP_TYPES}),
so AS (SELECT f.speech_id, f.type, f.chunk_no, f.sent_no, strpos(p.speech, f.sentence) - 1 AS start,
       length(f.sentence) AS len FROM fo f JOIN sp p USING (speech_id) JOIN tt t USING (speech_id, type))"""


def findings_sql(lexicon, routed):
    return (_findings_ctes(lexicon, routed) + "\nSELECT speech_id, CAST(chunk_no AS BIGINT) AS chunk_no, "
            "CAST(sent_no AS BIGINT) AS sent_no, type, sentence FROM fo")


def type_counts_sql():
    return (_findings_ctes(PROBE, False) + "\nSELECT speech_id, type, CAST(n AS BIGINT) AS n, "
            "CAST(first_seen AS BIGINT) AS first_seen FROM tc")


def top_types_sql():
    return (_findings_ctes(PROBE, False) + "\nSELECT speech_id, CAST(rank AS BIGINT) AS rank, type, "
            "CAST(n AS BIGINT) AS n FROM tt")


def offsets_sql():
    return (_findings_ctes(PROBE, False) + "\nSELECT speech_id, type, CAST(chunk_no AS BIGINT) AS chunk_no, "
            "CAST(sent_no AS BIGINT) AS sent_no, CAST(start AS BIGINT) AS start, CAST(start + len AS BIGINT) AS \"end\" "
            "FROM so")


def report_sql(lexicon, flag=None):
    lab = T.duck_label("type")
    return _findings_ctes(lexicon, True, flag) + f""",
pt AS (SELECT speech_id, type, rank, coalesce(string_agg(CASE WHEN start >= 0 THEN '[' || start || ':' || (start + len) || ']' END,
       ', ' ORDER BY chunk_no, sent_no), '') AS spans FROM so JOIN tt USING (speech_id, type) GROUP BY speech_id, type, rank),
rep AS (SELECT speech_id, string_agg({lab}, {NL} ORDER BY rank) AS types_text,
        string_agg({lab} || ': ' || spans, {NL} ORDER BY rank) AS offsets_text FROM pt GROUP BY speech_id)
SELECT u.speech_id,
       CASE WHEN u.code <> 1 THEN 'Not propaganda' WHEN r.speech_id IS NULL THEN 'Not identified' ELSE r.types_text END
         AS propaganda_type,
       CASE WHEN u.code = 1 THEN r.offsets_text END AS offsets
FROM usable u LEFT JOIN rep r USING (speech_id)"""


# ---- statistics ------------------------------------------------------------------------------

COUNTERS = f"""cw AS (SELECT speech_id, surname, speech, regexp_extract_all(speech, '{T.WORD}') AS w FROM usable),
cs AS (SELECT speech_id, surname, speech, w, list_transform(w, lambda x: {_syl('x')}) AS syl FROM cw),
counters AS (SELECT speech_id, surname, speech,
  CAST(len(w) AS BIGINT) AS words,
  CAST(greatest(1, len(list_filter({T.duck_sentences('speech')}, lambda s: s <> ''))) AS BIGINT) AS sentences,
  CAST(coalesce(list_sum(syl), 0) AS BIGINT) AS syllables,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS characters,
  CAST(len(list_filter(syl, lambda y: y >= 3)) AS BIGINT) AS polysyllables FROM cs)"""


def _read_exprs():
    W, S, Y, P, C = ("CAST(words AS DOUBLE)", "CAST(sentences AS DOUBLE)", "CAST(syllables AS DOUBLE)",
                     "CAST(polysyllables AS DOUBLE)", "CAST(characters AS DOUBLE)")
    fre = f"(206.835 - 1.015 * {W} / {S} - 84.6 * {Y} / {W})"
    fk = f"(0.39 * {W} / {S} + 11.8 * {Y} / {W} - 15.59)"
    fog = f"(0.4 * ({W} / {S} + 100.0 * {P} / {W}))"
    smog = f"(CASE WHEN {S} < 3 THEN 0.0 ELSE 1.0430 * sqrt(30.0 * {P} / {S}) + 3.1291 END)"
    cli = f"(0.0588 * 100.0 * {C} / {W} - 0.296 * 100.0 * {S} / {W} - 15.8)"
    ari = f"(4.71 * {C} / {W} + 0.5 * {W} / {S} - 21.43)"
    return fre, fk, fog, smog, cli, ari


def readability_sql():
    fre, fk, fog, smog, cli, ari = _read_exprs()
    grades = "[" + ", ".join(f"CAST(floor({g} + 0.5) AS BIGINT)" for g in (fk, fog, smog, cli, ari)) + "]"
    return f"""{BASE}, {COUNTERS},
rd AS (SELECT speech_id, words, {fre} AS fre, {fk} AS fk, {fog} AS fog, {smog} AS smog, {grades} AS g FROM counters),
md AS (SELECT *, list_sort(list_transform(g, lambda x: {{'neg': -len(list_filter(g, lambda y: y = x)), 'g': x}}))[1].g AS m FROM rd)
SELECT speech_id,
  CASE WHEN words > 0 THEN round(fre, 6) END AS flesch_reading_ease,
  CASE WHEN words > 0 THEN round(fk, 6) END AS flesch_kincaid_grade,
  CASE WHEN words > 0 THEN round(fog, 6) END AS gunning_fog,
  CASE WHEN words > 0 THEN round(smog, 6) END AS smog_index,
  CASE WHEN words > 0 THEN {_ordinal('m - 1')} || ' and ' || {_ordinal('m')} || ' grade' END AS text_standard
FROM md"""


def _persuasion_cte():
    tok = f"regexp_extract_all(lower(speech), '{T.DUCK_PTOKEN}')"
    sup = (f"len(list_filter(tok, lambda t: t IN {in_list(SUPERLATIVE_WORDS)} OR "
           f"(regexp_matches(t, '^\\p{{L}}{{3,}}est$') AND t NOT IN {in_list(NOT_SUPERLATIVE)})))")
    ques = f"len(list_filter({T.duck_sentences('speech')}, lambda s: regexp_matches(s, '\\?{T.DUCK_WS}*$')))"
    lex = [f"len(list_filter(tok, lambda t: t IN {in_list(ws)}))" for _, ws in PERSUASION]
    names = [n for n, _ in PERSUASION_WEIGHTS]
    cols = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in zip(names, [sup, ques] + lex))
    return (f"pt AS (SELECT speech_id, surname, speech, {tok} AS tok FROM usable),\n"
            f"pc AS (SELECT speech_id, surname, {cols}, CAST(len(tok) AS BIGINT) AS total_tokens FROM pt)")


def _score_exprs():
    out = []
    for n, w in PERSUASION_WEIGHTS:
        out.append((n, f"(CASE WHEN total_tokens > 0 THEN {n} / total_tokens * CAST({w!r} AS DOUBLE) ELSE 0.0 END)"))
    return out


def persuasion_counts_sql():
    names = [n for n, _ in PERSUASION_WEIGHTS]
    return f"{BASE}, {_persuasion_cte()}\nSELECT speech_id, {', '.join(names)}, total_tokens FROM pc"


def persuasion_score_sql():
    sc = _score_exprs()
    total = " + ".join(e for _, e in sc)
    return (f"{BASE}, {_persuasion_cte()}\nSELECT speech_id, "
            + ", ".join(f"round({e}, 6) AS {n}" for n, e in sc)
            + f", round(CAST(printf('%.3f', {total}) AS DOUBLE), 6) AS total_score FROM pc")


def persuasion_text_sql():
    """DuckDB prints doubles the way Python does, so the cast is the reference rendering."""
    sc = _score_exprs()
    total = " + ".join(e for _, e in sc)
    items = [(n, e) for n, e in sc] + [("total_score", f"CAST(printf('%.3f', {total}) AS DOUBLE)")]
    lines = ", ".join(f"{q(title_literal(n) + ': ')} || CAST({e} AS VARCHAR)" for n, e in items)
    return f"{BASE}, {_persuasion_cte()}\nSELECT speech_id, concat_ws({NL}, {lines}) AS persuasion_text FROM pc"


def per_speaker_sql():
    fre = _read_exprs()[0]
    total = " + ".join(e for _, e in _score_exprs())
    return f"""{BASE}, {COUNTERS}, {_persuasion_cte()},
m AS (SELECT c.surname, CAST(printf('%.3f', {total}) AS DOUBLE) AS ts, CASE WHEN c.words > 0 THEN {fre} END AS fre, c.words
      FROM counters c JOIN pc USING (speech_id))
SELECT surname, count(*) AS speeches, round(avg(ts), 6) AS avg_total_score,
       round(avg(fre), 6) AS avg_flesch_reading_ease, round(avg(words), 6) AS avg_words FROM m GROUP BY surname"""


def narrative_sql():
    return f"""{BASE},
se AS (SELECT speech_id, unnest(list_filter({T.duck_sentences('speech')}, lambda s: s <> '')) AS s FROM usable),
ln AS (SELECT speech_id, len({T.duck_words('s')}) AS n FROM se)
SELECT speech_id, round(avg(n), 6) AS avg_sentence_length, round(stddev_pop(n), 6) AS sentence_length_std,
       count(*) AS total_sentences, round(avg(n) / (stddev_pop(n) + 1), 6) AS complexity FROM ln GROUP BY speech_id"""


def narrative_text_sql():
    """A2: DuckDB's printf rounds the exact binary value half-even, as Python's %.3f does."""
    return f"""{BASE},
se AS (SELECT speech_id, unnest(list_filter({T.duck_sentences('speech')}, lambda s: s <> '')) AS s FROM usable),
ln AS (SELECT speech_id, len({T.duck_words('s')}) AS n FROM se),
ag AS (SELECT speech_id, avg(n) AS m, stddev_pop(n) AS sd, count(*) AS c FROM ln GROUP BY speech_id)
SELECT speech_id, 'Average Sentence Length: ' || printf('%.3f', m) || {NL} || 'Sentence Length Variation: ' ||
       printf('%.3f', sd) || {NL} || 'Total Sentences: ' || CAST(c AS VARCHAR) || {NL} || 'Complexity Score: ' ||
       printf('%.3f', m / (sd + 1)) AS narrative_text FROM ag"""


# ---- keywords --------------------------------------------------------------------------------

def _term_counts_cte():
    return f"""tt0 AS (SELECT speech_id, unnest({T.duck_terms('speech')}) AS term FROM usable),
tcn AS (SELECT speech_id, term, count(*) AS cnt FROM tt0 WHERE term NOT IN {in_list(stop_words())}
        GROUP BY speech_id, term)"""


def term_weights_sql():
    return (f"{BASE}, {_term_counts_cte()}\nSELECT speech_id, term, cnt, "
            "round(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY speech_id)), 6) AS weight FROM tcn")


def top_keywords_sql():
    return (f"{BASE}, {_term_counts_cte()},\nwt AS (SELECT speech_id, term, cnt, "
            "cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY speech_id)) AS weight, "
            "row_number() OVER (PARTITION BY speech_id ORDER BY cnt DESC, term) AS rank FROM tcn)\n"
            f"SELECT speech_id, CAST(rank AS BIGINT) AS rank, term, cnt, round(weight, 6) AS weight FROM wt "
            f"WHERE rank <= {TOP_KEYWORDS}")


def keyword_text_sql():
    """K3: title case spelled out per character (Python's rule), weights via printf (exact)."""
    title = ("array_to_string(list_transform(string_split(term, ''), lambda c, i: CASE WHEN i = 1 OR "
             "upper(string_split(term, '')[i - 1]) = lower(string_split(term, '')[i - 1]) THEN upper(c) "
             "ELSE lower(c) END), '')")
    return (f"{BASE}, {_term_counts_cte()},\nwt AS (SELECT speech_id, term, cnt, "
            "cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY speech_id)) AS weight, "
            "row_number() OVER (PARTITION BY speech_id ORDER BY cnt DESC, term) AS rank FROM tcn)\n"
            f"SELECT u.speech_id, coalesce(string_agg({title} || ': ' || printf('%.3f', weight), {NL} ORDER BY rank), '') "
            f"AS keyword_text FROM usable u LEFT JOIN (SELECT * FROM wt WHERE rank <= {TOP_KEYWORDS}) k "
            f"USING (speech_id) GROUP BY u.speech_id")


def _corpus_weights_cte():
    return f"""{_term_counts_cte()},
dfr AS (SELECT term, count(*) AS df FROM tcn GROUP BY term),
ti AS (SELECT speech_id, term, cnt, cnt * (ln((1.0 + (SELECT count(*) FROM usable)) / (df + 1)) + 1) AS tfidf
       FROM tcn JOIN dfr USING (term)),
cw AS (SELECT *, tfidf / sqrt(sum(tfidf * tfidf) OVER (PARTITION BY speech_id)) AS weight FROM ti)"""


def corpus_keywords_sql():
    return f"""{BASE}, {_corpus_weights_cte()},
rk AS (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY tfidf DESC, term) AS rank FROM cw)
SELECT speech_id, term, cnt, round(weight, 6) AS weight, CAST(rank AS BIGINT) AS rank FROM rk WHERE rank <= {TOP_KEYWORDS}"""


def summary_sentences_sql():
    return f"""{BASE}, {_corpus_weights_cte()},
se AS (SELECT speech_id, unnest(ss) AS sentence, unnest(range(len(ss))) AS sent_no
       FROM (SELECT speech_id, list_filter({T.duck_sentences('speech')}, lambda s: s <> '') AS ss FROM usable)),
sw AS (SELECT speech_id, sent_no, sentence, len({T.duck_words('sentence')}) AS n_words FROM se),
st AS (SELECT speech_id, sent_no, unnest({T.duck_terms('sentence')}) AS term FROM se),
sc AS (SELECT st.speech_id, st.sent_no, avg(cw.weight) AS score FROM st JOIN cw USING (speech_id, term)
       WHERE st.term NOT IN {in_list(stop_words())} GROUP BY st.speech_id, st.sent_no),
rk AS (SELECT sw.*, sc.score, row_number() OVER w AS rank, sum(n_words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
       FROM sw LEFT JOIN sc USING (speech_id, sent_no)
       WINDOW w AS (PARTITION BY speech_id ORDER BY round(sc.score, 9) DESC NULLS LAST, sent_no))
SELECT speech_id, CAST(sent_no AS BIGINT) AS sent_no, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score,
       CAST(n_words AS BIGINT) AS n_words, sentence FROM rk WHERE so_far <= {SUMMARY_WORDS}"""


def enrich_values_sql():
    """All 31 enrichment columns (+ id), composed from the pieces above: profiles (J1/J2),
    responses (J3/X1/X2), toxicity text (L3), propaganda report (F6/P1-P7), persuasion text
    (A9-A11), keyword text (K1-K3), narrative text (A1-A2), readability (A3-A8), tone (L7) with the
    probe lexicon; sentiment and emotion are null without models."""
    from ..functions.lexicons import RESPONSE_FIELDS
    lab = T.duck_label("type")
    fre, fk, fog, smog, cli, ari = _read_exprs()
    grades = "[" + ", ".join(f"CAST(floor({g} + 0.5) AS BIGINT)" for g in (fk, fog, smog, cli, ari)) + "]"
    hits = hits_sql("lower(u.speech)", TOXICITY)
    tox = ", ".join(f"CASE WHEN {h} > 0 THEN {q(title_literal(c) + ': ')} || CAST({h} AS VARCHAR) END"
                    for (c, _), h in zip(TOXICITY, hits))
    fields = []
    for i, n in enumerate(RESPONSE_FIELDS, start=1):
        v = f"CASE WHEN len(r.parts) >= {i} THEN r.parts[{i}] ELSE 'N/A' END"
        if n == "underlying_narrative":
            v = f"replace({v}, ';', {NL} || {NL})"
        fields.append(f"{v} AS {n}")
    prof = ", ".join(f"CASE WHEN p.surname IS NOT NULL THEN {v} END AS {n}" for n, v in
                     [("birthday", "'N/A'"), ("birth_place", "'N/A'"), ("death_day", "CAST(NULL AS VARCHAR)"),
                      ("death_place", "CAST(NULL AS VARCHAR)"), ("party", "'N/A'")])
    sc = _score_exprs()
    total = " + ".join(e for _, e in sc)
    items = [(n, e) for n, e in sc] + [("total_score", f"CAST(printf('%.3f', {total}) AS DOUBLE)")]
    pers_lines = ", ".join(f"{q(title_literal(n) + ': ')} || CAST({e} AS VARCHAR)" for n, e in items)
    title = ("array_to_string(list_transform(string_split(term, ''), lambda c, i: CASE WHEN i = 1 OR "
             "upper(string_split(term, '')[i - 1]) = lower(string_split(term, '')[i - 1]) THEN upper(c) "
             "ELSE lower(c) END), '')")
    return _findings_ctes(PROPAGANDA, True) + f""",
pts AS (SELECT speech_id, type, rank, coalesce(string_agg(CASE WHEN start >= 0 THEN '[' || start || ':' || (start + len) || ']' END,
       ', ' ORDER BY chunk_no, sent_no), '') AS spans FROM so JOIN tt USING (speech_id, type) GROUP BY speech_id, type, rank),
rep AS (SELECT speech_id, string_agg({lab}, {NL} ORDER BY rank) AS types_text,
        string_agg({lab} || ': ' || spans, {NL} ORDER BY rank) AS offsets_text FROM pts GROUP BY speech_id),
{_pick_cte()},
resp AS (SELECT text AS speech, concat_ws('$', source, lang, CAST(n_chars AS VARCHAR), text) AS response,
         doc_id AS seq FROM documents),
latest AS (SELECT speech, arg_max(response, seq) AS response FROM resp GROUP BY speech),
rr AS (SELECT u.speech_id, string_split(l.response, '$') AS parts FROM usable u LEFT JOIN latest l ON u.speech = l.speech),
{COUNTERS},
rd AS (SELECT speech_id, words, {fre} AS fre, {fk} AS fk, {fog} AS fog, {smog} AS smog, {grades} AS g FROM counters),
md AS (SELECT *, list_sort(list_transform(g, lambda x: {{'neg': -len(list_filter(g, lambda y: y = x)), 'g': x}}))[1].g AS m FROM rd),
{_persuasion_cte()},
ptx AS (SELECT speech_id, concat_ws({NL}, {pers_lines}) AS persuasion_score FROM pc),
{_term_counts_cte()},
kwt AS (SELECT speech_id, term, cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY speech_id)) AS weight,
        row_number() OVER (PARTITION BY speech_id ORDER BY cnt DESC, term) AS rank FROM tcn),
ktx AS (SELECT u.speech_id, coalesce(string_agg({title} || ': ' || printf('%.3f', weight), {NL} ORDER BY rank), '')
        AS tf_idf FROM usable u LEFT JOIN (SELECT * FROM kwt WHERE rank <= {TOP_KEYWORDS}) k USING (speech_id)
        GROUP BY u.speech_id),
nse AS (SELECT speech_id, unnest(list_filter({T.duck_sentences('speech')}, lambda s: s <> '')) AS s FROM usable),
nln AS (SELECT speech_id, len({T.duck_words('s')}) AS n FROM nse),
nag AS (SELECT speech_id, 'Average Sentence Length: ' || printf('%.3f', avg(n)) || {NL} || 'Sentence Length Variation: ' ||
        printf('%.3f', stddev_pop(n)) || {NL} || 'Total Sentences: ' || CAST(count(*) AS VARCHAR) || {NL} ||
        'Complexity Score: ' || printf('%.3f', avg(n) / (stddev_pop(n) + 1)) AS narrative_structure
        FROM nln GROUP BY speech_id)
SELECT u.speech_id, u.surname, CAST(u.code AS BIGINT) AS code, u.speech, p.title AS full_name, {prof},
  {", ".join(fields)},
  concat_ws({NL}, {tox}) AS toxicity_text_count,
  CASE WHEN u.code <> 1 THEN 'Not propaganda' WHEN e.speech_id IS NULL THEN 'Not identified' ELSE e.types_text END
    AS propaganda_type,
  CASE WHEN u.code = 1 THEN e.offsets_text END AS offsets,
  CAST(NULL AS VARCHAR) AS sentiment, CAST(NULL AS VARCHAR) AS emotion, x.persuasion_score, k.tf_idf,
  nn.narrative_structure, tn.tone,
  CASE WHEN md.words > 0 THEN round(md.fre, 6) END AS flesch_reading_ease,
  CASE WHEN md.words > 0 THEN round(md.fk, 6) END AS flesch_kincaid_grade,
  CASE WHEN md.words > 0 THEN round(md.fog, 6) END AS gunning_fog,
  CASE WHEN md.words > 0 THEN round(md.smog, 6) END AS smog_index,
  CASE WHEN md.words > 0 THEN {_ordinal('md.m - 1')} || ' and ' || {_ordinal('md.m')} || ' grade' END AS text_standard
FROM usable u LEFT JOIN pick p USING (surname) JOIN rr r USING (speech_id) LEFT JOIN rep e USING (speech_id)
  JOIN md USING (speech_id) JOIN ptx x USING (speech_id) JOIN ktx k USING (speech_id)
  LEFT JOIN nag nn USING (speech_id) JOIN ({tone_sql('usable', 'speech_id', 'speech')}) tn USING (speech_id)"""


# ---- joins, parsing --------------------------------------------------------------------------

def _pick_cte():
    cond = "(" + " OR ".join(f"contains(lower(title), {q(k)})" for k in POLITICIAN_KEYWORDS) + ")"
    return (f"hits AS (SELECT source AS surname, doc_id AS rank, {T.duck_sentences('text')}[1] AS title FROM documents),\n"
            f"pick AS (SELECT surname, min(rank) AS page_rank, arg_min(title, rank) AS title FROM hits "
            f"WHERE coalesce({cond}, false) GROUP BY surname)")


def _parse_cols(src: str) -> str:
    from ..functions.lexicons import RESPONSE_FIELDS
    cols = []
    for i, n in enumerate(RESPONSE_FIELDS, start=1):
        v = f"CASE WHEN len(parts) >= {i} THEN parts[{i}] ELSE 'N/A' END"
        if n == "underlying_narrative":
            v = f"replace({v}, ';', {NL} || {NL})"
        cols.append(f"{v} AS {n}")
    return ", ".join(cols) + ", CAST(coalesce(len(parts), 0) AS BIGINT) AS fields_found"


def response_join_sql():
    return f"""{BASE},
resp AS (SELECT text AS speech, concat_ws('$', source, lang, CAST(n_chars AS VARCHAR), text) AS response,
         doc_id AS seq FROM documents),
latest AS (SELECT speech, arg_max(response, seq) AS response FROM resp GROUP BY speech),
j AS (SELECT u.speech_id, string_split(l.response, '$') AS parts FROM usable u LEFT JOIN latest l ON u.speech = l.speech)
SELECT speech_id, {_parse_cols('parts')} FROM j"""


def parse_responses_sql():
    return f"SELECT doc_id, {_parse_cols('parts')} FROM (SELECT doc_id, string_split(text, '$') AS parts FROM documents)"


def lexicon_hits_sql(lexicon):
    hits = hits_sql("lc", lexicon)
    parts = " UNION ALL ".join(
        f"SELECT doc_id, {q(c)} AS category, {i} AS cat_order, h{i} AS hits FROM h" for i, (c, _) in enumerate(lexicon))
    return (f"WITH h AS (SELECT doc_id, {', '.join(f'{e} AS h{i}' for i, e in enumerate(hits))} "
            f"FROM (SELECT doc_id, lower(text) AS lc FROM documents))\n"
            f"SELECT doc_id, category, CAST(cat_order AS BIGINT) AS cat_order, CAST(hits AS BIGINT) AS hits "
            f"FROM ({parts}) WHERE hits > 0")


def predominant_sql_query():
    return (f"SELECT doc_id, {predominant_sql(hits_sql('lc', TOXICITY), TOXICITY)} AS toxicity_type, "
            f"{predominant_sql(hits_sql('lc', PROBE), PROBE)} AS probe_type "
            f"FROM (SELECT doc_id, lower(text) AS lc FROM documents)")


def toxicity_text_sql():
    hits = hits_sql("lc", TOXICITY)
    parts = ", ".join(f"CASE WHEN {h} > 0 THEN {q(title_literal(c) + ': ')} || CAST({h} AS VARCHAR) END"
                      for (c, _), h in zip(TOXICITY, hits))
    return f"SELECT doc_id, concat_ws({NL}, {parts}) AS toxicity FROM (SELECT doc_id, lower(text) AS lc FROM documents)"


def token_lexicon_counts_sql():
    tok = f"regexp_extract_all(lower(text), '{T.DUCK_PTOKEN}')"
    cols = ", ".join(f"CAST(len(list_filter(tok, lambda t: t IN {in_list(ws)})) AS BIGINT) AS {n}"
                     for n, ws in PERSUASION)
    return f"SELECT doc_id, {cols} FROM (SELECT doc_id, {tok} AS tok FROM documents)"


def tone_sql(table="documents", key="doc_id", text="text"):
    groups: dict[float, list[str]] = {}
    for w, v in PROBE_TONE:
        groups.setdefault(float(v), []).append(w)
    counts = [(v, f"len(list_filter(tok, lambda t: t IN {in_list(ws)}))") for v, ws in sorted(groups.items())]
    n = "0 + " + " + ".join(c for _, c in counts)
    s = "0.0 + " + " + ".join(f"{c} * CAST({v!r} AS DOUBLE)" for v, c in counts)
    subj = f"(CASE WHEN ({n}) > 0 THEN ({s}) / ({n}) ELSE 0.0 END)"
    return (f"SELECT {key}, round({subj}, 6) AS subjectivity, CASE WHEN {subj} < 0.5 THEN 'Formal' ELSE 'Informal' END "
            f"AS tone FROM (SELECT {key}, {T.duck_terms(text)} AS tok FROM {table})")


def _corpus_words_cte(least_length):
    return (f"tk AS (SELECT doc_id, unnest({T.duck_terms('text')}) AS word FROM documents),\n"
            f"lx AS (SELECT DISTINCT word FROM tk WHERE length(word) >= {least_length})")


def token_lexicon_table_sql():
    return f"""WITH {_corpus_words_cte(5)},
lc AS (SELECT word, 'length_' || CAST(length(word) % 9 AS VARCHAR) AS category FROM lx)
SELECT doc_id, category, count(*) AS n FROM tk JOIN lc USING (word) GROUP BY doc_id, category"""


def tone_table_sql():
    return f"""WITH {_corpus_words_cte(6)},
lw AS (SELECT word, ((length(word) * 31 + 7 * (length(word) - length(replace(word, 'a', '')))) % 97) / 96.0::DOUBLE AS weight FROM lx),
m AS (SELECT doc_id, avg(weight) AS s FROM tk JOIN lw USING (word) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(m.s, 0.0), 6) AS subjectivity, CASE WHEN coalesce(m.s, 0.0) < 0.47 THEN 'Formal' ELSE 'Informal' END AS tone
FROM documents d LEFT JOIN m USING (doc_id)"""


def speech_embeddings_sql(dim=64):
    """Each place of a chunk's vector: words of its even code less words of its odd one, by the chunk's words."""
    return f"""{BASE},
ww AS (SELECT speech_id, {T.duck_words('speech')} AS w FROM usable),
st AS (SELECT speech_id, w, unnest(generate_series(0, len(w) - 1, {STEP})) AS st FROM ww WHERE len(w) > 0),
tk AS (SELECT speech_id, st, unnest(w[st + 1 : st + {CHUNK_SIZE}]) AS t, len(w[st + 1 : st + {CHUNK_SIZE}]) AS n FROM st),
cd AS (SELECT speech_id, st, n, ('0x' || substring(md5(lower(t)), 1, 8))::BIGINT % {2 * dim} AS code FROM tk),
ch AS (SELECT speech_id, st, code // 2 AS dim, sum(CASE WHEN code % 2 = 0 THEN 1 ELSE -1 END) / any_value(n) AS v
       FROM cd GROUP BY speech_id, st, code // 2),
sp AS (SELECT speech_id, dim, sum(v) AS v FROM ch GROUP BY speech_id, dim),
nc AS (SELECT speech_id, count(*) AS c FROM st GROUP BY speech_id),
dm AS (SELECT unnest(range({dim})) AS dim)
SELECT u.speech_id, dm.dim, round(coalesce(sp.v / nc.c, 0.0), 10) AS value
FROM usable u CROSS JOIN dm LEFT JOIN sp ON sp.speech_id = u.speech_id AND sp.dim = dm.dim LEFT JOIN nc ON nc.speech_id = u.speech_id"""


def extract_responses_sql():
    return """SELECT source AS name, md5(text) AS speech_md5, source || '$' || length(text) || '$first words: ' || substring(text, 1, 20)
  AS response, max(doc_id) AS seq, CAST(CASE WHEN length(text) % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS generation
FROM documents GROUP BY source, text"""


# Each text is built when it is asked for, so a fault in one leaves the others usable.
ORACLE: dict[str, Callable[[], str]] = {
    "drop_incomplete": lambda: (f"{BASE} SELECT speech_id, surname, CAST(code AS BIGINT) AS code, "
                       "CAST(length(speech) AS BIGINT) AS n_chars FROM complete"),
    "exact_dedup": lambda: (f"{BASE} SELECT min(speech_id) AS speech_id, surname, CAST(code AS BIGINT) AS code, "
                   "CAST(length(speech) AS BIGINT) AS n_chars FROM complete GROUP BY surname, code, speech"),
    "remove_links": lambda: (f"SELECT doc_id, cleaned, CAST(length(cleaned) AS BIGINT) AS n_chars FROM (SELECT doc_id, "
                     + T.duck_remove_links("substring(text, 1, 120) || ' see http://example.org/a?b=1' || chr(160) || "
                                           "'tail www.example.com/x end ' || substring(text, 121)")
                     + " AS cleaned FROM documents)"),
    "usable_filter": lambda: (f"{BASE} SELECT speech_id, surname, CAST(code AS BIGINT) AS code, "
                     "CAST(length(speech) AS BIGINT) AS n_chars FROM usable"),
    "politician_predicate": lambda: ("SELECT doc_id, CAST(coalesce(" + " OR ".join(
        f"contains(lower({T.duck_sentences('text')}[1]), {q(k)})" for k in POLITICIAN_KEYWORDS)
        + ", false) AS BIGINT) AS is_politician FROM documents"),
    "speech_file_roundtrip": lambda: (f"{BASE} SELECT surname, CAST(code AS BIGINT) AS code, "
                             "CAST(length(speech) AS BIGINT) AS n_chars, speech FROM usable"),
    "distinct_speakers": lambda: f"{BASE} SELECT DISTINCT surname FROM usable",
    "first_qualifying_hit": lambda: f"WITH {_pick_cte()} SELECT surname, page_rank, title FROM pick",
    "profile_join": lambda: (f"{BASE}, {_pick_cte()} SELECT u.speech_id, u.surname, p.title AS full_name, p.page_rank "
                     "FROM usable u LEFT JOIN pick p USING (surname)"),
    "response_join": response_join_sql,
    "parse_responses": parse_responses_sql,
    "page_titles": lambda: "SELECT page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS title FROM pages",
    "lexicon_hits_propaganda": lambda: lexicon_hits_sql(PROPAGANDA),
    "lexicon_hits_toxicity": lambda: lexicon_hits_sql(TOXICITY),
    "lexicon_hits_probe": lambda: lexicon_hits_sql(PROBE),
    "predominant_category": predominant_sql_query,
    "toxicity_text": toxicity_text_sql,
    "token_lexicon_counts": token_lexicon_counts_sql,
    "tone": tone_sql,
    "token_lexicon_table": token_lexicon_table_sql,
    "tone_table": tone_table_sql,
    "sliding_windows": lambda: (f"WITH ww AS (SELECT doc_id, {T.duck_words('text')} AS w FROM documents), "
                        f"st AS (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1, {STEP})) AS st FROM ww "
                        f"WHERE len(w) > 0) SELECT doc_id, CAST(st // {STEP} AS BIGINT) AS chunk_no, "
                        f"CAST(len(w[st + 1 : st + {CHUNK_SIZE}]) AS BIGINT) AS n_words, "
                        f"array_to_string(w[st + 1 : st + {CHUNK_SIZE}], ' ') AS chunk FROM st"),
    "sentences": lambda: (f"SELECT doc_id, CAST(sent_no AS BIGINT) AS sent_no, sentence FROM (SELECT doc_id, "
                  f"unnest(ss) AS sentence, unnest(range(len(ss))) AS sent_no FROM "
                  f"(SELECT doc_id, {T.duck_sentences('text')} AS ss FROM documents))"),
    "speech_embeddings": speech_embeddings_sql,
    "extract_responses": extract_responses_sql,
    "token_rows": lambda: (f"SELECT doc_id, CAST(pos AS BIGINT) AS pos, token FROM (SELECT doc_id, unnest(t) AS token, "
                   f"unnest(range(len(t))) AS pos FROM (SELECT doc_id, {T.duck_terms('text')} AS t FROM documents))"),
    "token_counts": lambda: (f"SELECT doc_id, CAST(len({T.duck_words('text')}) AS BIGINT) AS n_words, "
                     f"CAST(len({T.duck_terms('text')}) AS BIGINT) AS n_terms, "
                     f"CAST(len({T.duck_sentences('text')}) AS BIGINT) AS n_sentences FROM documents"),
    "propaganda_findings": lambda: findings_sql(PROPAGANDA, True),
    "propaganda_findings_probe": lambda: findings_sql(PROBE, False),
    "propaganda_type_counts": type_counts_sql,
    "propaganda_top_types": top_types_sql,
    "propaganda_offsets": offsets_sql,
    "propaganda_report": lambda: report_sql(PROPAGANDA),
    "propaganda_report_probe": lambda: report_sql(PROBE),
    "propaganda_report_flag": lambda: report_sql(PROBE, "length({text}) % 5 = 0"),
    "narrative_structure": narrative_sql,
    "narrative_text": narrative_text_sql,
    "text_counters": lambda: f"{BASE}, {COUNTERS} SELECT speech_id, words, sentences, syllables, characters, polysyllables FROM counters",
    "readability": readability_sql,
    "persuasion_counts": persuasion_counts_sql,
    "persuasion_score": persuasion_score_sql,
    "persuasion_text": persuasion_text_sql,
    "per_speaker": per_speaker_sql,
    "term_weights": term_weights_sql,
    "top_keywords": top_keywords_sql,
    "keyword_text": keyword_text_sql,
    "corpus_keywords": corpus_keywords_sql,
    "summary_sentences": summary_sentences_sql,
    "enrich_values": enrich_values_sql,
    "extract_profiles": lambda: (
        "SELECT n AS surname, " + ", ".join(f"CASE WHEN html IS NOT NULL THEN {v} END AS {c}" for c, v in [
            ("full_name", "'Page ' || n"), ("birthday", "n"),
            ("birth_place", "CASE WHEN page_id % 3 = 0 THEN 'Town ' || n ELSE 'Town ' || n || ', Land' END"),
            ("death_day", "CASE WHEN page_id % 2 = 0 THEN 'day ' || n END"),
            ("death_place", "CASE WHEN page_id % 2 = 0 THEN 'End ' || n || ', Land' END"),
            ("party", "CASE WHEN page_id % 5 = 0 THEN 'N/A' ELSE 'Party ' || n END")])
        + " FROM (SELECT page_id, CAST(page_id AS VARCHAR) AS n, html FROM pages)"),
    "nearest_vectors": lambda: (
        "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), p AS (SELECT a.vec_id, b.vec_id AS neighbour_id, "
        "round(list_cosine_similarity(a.e, b.e), 6) AS similarity FROM v a JOIN v b ON a.vec_id <> b.vec_id), r AS (SELECT *, "
        "row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour_id) AS rank FROM p) "
        "SELECT vec_id, rank, neighbour_id, similarity FROM r WHERE rank <= 5"),
    "mean_pool": lambda: ("SELECT label, CAST(i - 1 AS BIGINT) AS dim, round(avg(v), 6) AS value FROM ("
                  "SELECT CAST(label AS BIGINT) AS label, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i "
                  "FROM embeddings) GROUP BY label, i"),
}
