"""Conversation repair: the search against a plain table of (cost, audit), and the query word by word against its contract."""

import hashlib
import random
import re
import zlib

import pytest

from oratio.llm import registry, turn_repair as tr

CHAR = re.compile(r"[^\x20\x09-\x0D]")


def plain_search(initials, faults):
    """All states' cheapest (cost, audit), row by row; three rounds of inserts reach every state."""
    never = (1 << 50, "")

    def inserted(v):
        v = list(v)
        for _ in range(3):
            for s, to in enumerate((2, 2, 3, 2)):
                v[to] = min(v[to], (v[s][0] + 5, v[s][1] + "I"))
        return v

    v = inserted([(0, ""), never, never, never])
    for who, fault in zip(initials, faults):
        w = [(c + 2, a + "D") for c, a in v]
        if fault not in "bd":
            extra = 5 * (fault == "t")
            for s, (c, a) in enumerate(v):
                to = (2, 2, 3, 2)[s]
                w[to] = min(w[to], (c + 1 + extra, a + "R"))
                if who == "s" and s == 0:
                    w[1] = min(w[1], (c + extra, a + "K"))
                if who == "u" and s != 2 or who == "a" and s == 2:
                    w[to] = min(w[to], (c + extra, a + "K"))
        v = inserted(w)
    return min(v[0], v[3])


def test_search_equals_plain_table():
    rnd = random.Random(12)
    for _ in range(4000):
        n = rnd.randint(0, 16)
        initials = "".join(rnd.choice("suuaaax ") for _ in range(n))
        faults = "".join(rnd.choice("----tbd") for _ in range(n))
        cost, audit, state = tr.cheapest(initials, faults.translate(tr.CLASSES))
        assert (cost, audit + "I" * (tr.END[state] // 5)) == plain_search(initials, faults), (initials, faults)


def test_blocks_chain_to_the_same_audit():
    rnd = random.Random(13)
    for _ in range(600):
        n = rnd.randint(1, 40)
        initials = "".join(rnd.choice("suuaaax ") for _ in range(n))
        faults = "".join(rnd.choice("0000112") for _ in range(n))
        cuts = [0, *sorted(rnd.sample(range(n + 1), min(n, rnd.randint(0, 6)))), n]
        parts = [(initials[a:b], faults[a:b]) for a, b in zip(cuts, cuts[1:])]
        to_go = tr._chain([tr.cost_table(*p) for p in parts])
        state, audit = 0, ""
        for p, v in zip(parts, to_go):
            cost, a, state = tr.cheapest(*p, state, v)
            audit += a
        whole = tr.cheapest(initials, faults)
        assert audit == whole[1] and state == whole[2]


def contract(conv, rows):
    """rows: all original (turn, role, text) of one conversation."""
    left = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        left += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), ""
    for _, role, text in left:
        core = CHAR.findall(text)
        faults += "b" if not core else "d" if (role, text) in seen else "-" if core[-1] in ".!?" else "t"
        seen.add((role, text))
    initials = "".join(r[1][:1] or " " for r in left)
    illegal = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
    turns = {r[0] for r in left} - {None}
    cost, audit = plain_search(initials, faults)
    i, out = 0, []
    for edit in audit:
        want = "assistant" if out and out[-1][0][0] == "u" else "user"
        if edit == "K":
            out.append(left[i][1:])
        elif edit == "R":
            out.append((want, left[i][2]))
        elif edit == "I":
            out.append((want, ""))
        i += edit != "I"
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out)) and i == len(left)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)


def table_rows():
    rnd = random.Random(14)
    says = ["Yes.", "No!", "Why?", "so", "", " \n", None, "a b. \t", "café.", "x" * 5000 + ".", "Yes.", "line\nbreak."]
    rows = []
    for conv in [*range(60), None, -3]:
        for turn in range(rnd.randint(1, 12)):
            rows.append((conv, rnd.choice([turn, turn + 2, turn, None]), rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]),
                         rnd.choice(says)))
    rows += [(1000, t, ("user", "assistant")[t % 2], f"turn {t % 700}.") for t in range(2600)]  # a third of the rows and more
    rows += [(1001, 0, "user", "same.")] * 300
    return rows + rows[:20]


@pytest.mark.parametrize("block", [7, 4096])
def test_query_on_small_table(spark, tmp_path, monkeypatch, block):
    rows = table_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "'x' AS Ord")
    df.repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(tr.repair, "__defaults__", (*tr.repair.__defaults__[:-2], block, tr.BLOCK_CHARS))
    got = {r[0]: tuple(r) for r in registry.op12(spark, str(tmp_path)).collect()}
    groups = {}
    for conv, *rest in rows:
        groups.setdefault(conv, []).append(tuple(rest))
    assert got.keys() == groups.keys()
    for conv, own in groups.items():
        assert got[conv] == contract(conv, own), conv


def test_long_conversation_lies_over_several_tasks(spark):
    df = spark.range(6000).selectExpr("CAST(1 AS LONG) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                      "concat('says ', id, '.') AS text").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = tr.repair(df, block=500).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) >= 12 and len({p.ord >> 40 for p in parts}) > 1 and max(len(p.roles) for p in parts) <= 500
    assert sum(len(p.roles) for p in parts) == 6000 and {p.cost for p in parts} == {0}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    done = tr.repair(empty)
    assert done.count() == 0 and tr.report(done).count() == 0 and tr.digests(done).count() == 0
