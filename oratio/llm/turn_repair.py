"""Conversation repair by bidirectional Dijkstra over the edit lattice.

The rows of a conversation, by turn (nulls first, then role and text), are read against the pattern
``(s?(ua)+)?`` of role initials (system, user, assistant). A lattice node is (rows read, state): 0 nothing kept,
1 after the system row, 2 after a user row, 3 after an assistant row. Edits: Keep costs 0, Rerole (to the role that
the state wants) 1, Delete 2, Insert (an empty row of that role) 5; a truncated row that stays adds 5, a blank
or duplicate row has to go. Forward and reverse heaps meet in the middle and go on until no equal-cost crossing
can be missing; of all cheapest edit lists the one with the least audit (the edits' initials in order) is
read off by walking the marked nodes: a node's edges carry different initials, so the least edge at each node decides.

Scale: rows are dealt by ranges of (conversation, turn, role, start of text), so a conversation of any length
lies over as many partitions as it needs, and are cut into blocks of at most ``BLOCK`` rows and ``BLOCK_CHARS``
characters. A conversation that lies in one block is finished where it is. One of several blocks goes on by
blocks: rows seen in earlier blocks are found by hash, each block gives its cheapest cost from each state to each state,
those tables (16 numbers a block) folded from the end give every block its costs to go, with which a block
runs the same search for each state it may be entered in; the states are then chained from the front. One
task holds one block, or 16 numbers for each block of a conversation.

Defined cases: null roles and texts are one space; a blank row has no ``[^\\x20\\x09-\\x0D]``; a row is
duplicate if an earlier row of the conversation has its role and text, truncated if its last such character is not
one of ``.!?``; the first of these counts. Null conversation ids form one conversation. Rows equal in turn, role
and text are alike. An empty table gives empty results.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, release

BLOCK = 4096
BLOCK_CHARS = 1 << 22
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NEVER = 1 << 40
STAYS = 0, 1, 2  # fault classes of a row: may stay, stays at a price, has to go
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
WANTS = (2, 2, 3, 2)  # the state that a new row leads to, by state
FROM = ((), (), (0, 1, 3), (2,))  # the states that such a row comes from
END = (0, 2 * INSERT, INSERT, 0)  # cost to close the pattern behind the last row
LEGAL = {"su", "ua", "au"}


def _edges(node: int, initials: str, faults: str):
    """(label, cost, next node) of a node, in the order of the labels. Node: 4 * rows read + state."""
    i, state = node >> 2, node & 3
    if i == len(initials):
        return
    yield "D", DELETE, node + 4
    yield "I", INSERT, node - state + WANTS[state]
    if faults[i] != "2":
        extra = TRUNCATED * (faults[i] == "1")
        kept = KEEP.get(initials[i], {}).get(state)
        if kept is not None:
            yield "K", extra, 4 * i + 4 + kept
        yield "R", REROLE + extra, 4 * i + 4 + WANTS[state]


def _back(node: int, initials: str, faults: str):
    """(cost, node before) of a node."""
    i, state = node >> 2, node & 3
    if i < len(initials):
        for before in FROM[state]:
            yield INSERT, node - state + before
    if i:
        yield DELETE, node - 4
        if faults[i - 1] != "2":
            extra = TRUNCATED * (faults[i - 1] == "1")
            for before, kept in KEEP.get(initials[i - 1], {}).items():
                if kept == state:
                    yield extra, 4 * i - 4 + before
            for before in FROM[state]:
                yield REROLE + extra, 4 * i - 4 + before


def cheapest(initials: str, faults: str, entry: int = 0, to_go=END) -> tuple[int, str, int]:
    """(cost, least audit, exit state) from state ``entry`` through all rows, ``to_go[s]`` being what state s behind the
    last row costs further. ``NEVER`` if there is no way."""
    n = len(initials)
    ahead = {entry: 0}
    behind = {4 * n + s: c for s, c in enumerate(to_go) if c < NEVER}
    front, rear = [(0, entry)], [(c, v) for v, c in behind.items()]
    heapify(rear)
    settled, done = [], set()
    best = behind.get(entry, NEVER)
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, node = heappop(front)
            if cost > ahead[node]:
                continue
            settled.append(node)
            for _, w, nxt in _edges(node, initials, faults):
                if cost + w < ahead.get(nxt, NEVER):
                    ahead[nxt] = cost + w
                    heappush(front, (cost + w, nxt))
                if nxt in behind and cost + w + behind[nxt] < best:
                    best = cost + w + behind[nxt]
        else:
            cost, node = heappop(rear)
            if cost > behind[node] or node in done:
                continue
            done.add(node)
            if node in ahead and ahead[node] + cost < best:
                best = ahead[node] + cost
            for w, before in _back(node, initials, faults):
                if cost + w < behind.get(before, NEVER):
                    behind[before] = cost + w
                    heappush(rear, (cost + w, before))
                if before in ahead and ahead[before] + w + cost < best:
                    best = ahead[before] + w + cost
    if best >= NEVER:
        return NEVER, "", 0
    # nodes of the front half on some cheapest way: those with a crossing, and tight predecessors of such
    marked = set()
    for node in sorted(settled, key=lambda v: (ahead[v], v >> 2), reverse=True):
        for _, w, nxt in _edges(node, initials, faults):
            on = ahead[node] + w
            if on + behind.get(nxt, NEVER) == best or (nxt in marked and on == ahead[nxt]):
                marked.add(node)
                break
    node, cost, audit = entry, 0, []
    while node >> 2 < n:
        for label, w, nxt in _edges(node, initials, faults):
            if cost + w + behind.get(nxt, NEVER) == best or (nxt in marked and cost + w == ahead[nxt]):
                audit.append(label)
                node, cost = nxt, cost + w
                break
        else:
            raise RuntimeError("the two searches did not meet")
    return best, "".join(audit), node & 3


def cost_table(initials: str, faults: str) -> list[int]:
    """Least cost from each state before the rows to each state behind them (16 numbers): one forward search each."""
    out = []
    for entry in range(4):
        cost, heap, final = {entry: 0}, [(0, entry)], [NEVER] * 4
        while heap:
            c, node = heappop(heap)
            if c > cost[node]:
                continue
            if node >> 2 == len(initials):
                final[node & 3] = c
            for _, w, nxt in _edges(node, initials, faults):
                if c + w < cost.get(nxt, NEVER):
                    cost[nxt] = c + w
                    heappush(heap, (c + w, nxt))
        out += final
    return out


def apply_edits(audit: str, entry: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The rows that an audit leaves, entered in state ``entry``."""
    names, state, i, kept, said = {2: "user", 3: "assistant"}, entry, 0, [], []
    for edit in audit:
        if edit != "D":
            state = KEEP[roles[i][:1]][state] if edit == "K" else WANTS[state]
            kept.append(roles[i] if edit == "K" else names[state])
            said.append("" if edit == "I" else texts[i])
        i += edit != "I"
    return kept, said


def _fault(role: str, text: str, seen: set) -> str:
    """The class of a row's first fault: b(lank), d(uplicate), t(runcated) or '-'. Adds the row to ``seen``."""
    again = (role, text) in seen
    seen.add((role, text))
    core = text.rstrip(" \t\n\v\f\r")
    return "b" if not core else "d" if again else "-" if core[-1] in ".!?" else "t"


def _pattern(roles, texts, seen_before=()) -> tuple[str, str]:
    """(initials, faults by letter) of the rows of a block; ``seen_before``: indexes known from earlier blocks."""
    seen, before = set(), set(seen_before)
    letters = []
    for i, (r, t) in enumerate(zip(roles, texts)):
        f = _fault(r, t, seen)
        letters.append("d" if i in before and f != "b" else f)
    return "".join(r[:1] or " " for r in roles), "".join(letters)


CLASSES = str.maketrans("-tbd", "0122")


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def _finish(roles, texts) -> dict:
    initials, letters = _pattern(roles, texts)
    cost, audit, state = cheapest(initials, letters.translate(CLASSES))
    kept, said = apply_edits(audit + "I" * (END[state] // INSERT), 0, roles, texts)
    return {"roles": kept, "texts": said, "blank": letters.count("b"), "duplicate": letters.count("d"),
            "truncated": letters.count("t"), "illegal": _illegal(initials), "cost": cost,
            "audit": audit + "I" * (END[state] // INSERT)}


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = ["turn_min", "turn_max", "turns", "turn_first", "turn_last"]


def _blocks(rows: DataFrame, block: int, chars: int) -> DataFrame:
    """One row a block of the sorted (conv, turn, role, text): finished where the block is a whole conversation that
    neither begins nor ends its partition, else the rows as they are."""
    sort = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    ordered = rows.repartitionByRange(*sort, F.substring("text", 1, 64)).sortWithinPartitions(*sort, "text")
    out = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T._parse_datatype_string(
        "ord long, closed boolean, roles array<string>, texts array<string>, "
        + ", ".join(f"{c} long" for c in TURNS + COUNTS) + ", audit string").fields])

    def run(batches):
        from pyspark import TaskContext

        base, number = TaskContext.get().partitionId() << 40, 0
        conv, first, cut, held, size = None, True, False, None, 0
        ready = []

        def emit(whole):
            nonlocal number
            turns, roles, texts = held
            known = [t for t in turns if t is not None]
            row = {"conv": conv, "ord": base + number, "closed": whole, "turn_min": known[0] if known else None,
                   "turn_max": known[-1] if known else None, "turns": len(set(known)), "turn_first": turns[0], "turn_last": turns[-1]}
            row |= _finish(roles, texts) if whole else {"roles": roles, "texts": texts}
            ready.append(row)
            number += 1

        for b in batches:
            for c, t, r, x in zip(*(col.to_pylist() for col in b.columns)):
                if held is not None and c != conv:
                    emit(not first and not cut)
                    held, size, first, cut = None, 0, False, False
                elif held is not None and (len(held[0]) >= block or size >= chars):
                    emit(False)
                    held, size, cut = None, 0, True
                if held is None:
                    conv, held = c, ([], [], [])
                held[0].append(t), held[1].append(r), held[2].append(x)
                size += len(x)
                if len(ready) >= 512 or (ready and size >= chars):
                    yield from _batches(ready, out)
                    ready.clear()
        if held is not None:
            emit(False)
        yield from _batches(ready, out)

    return ordered.mapInArrow(run, out)


def _batches(rows: list[dict], schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    if rows:
        yield from pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)).to_batches()


def _seen_before(open_: DataFrame) -> DataFrame:
    """(ord, seen): indexes of a block's rows whose role and text occur in an earlier block of the conversation."""
    each = open_.select("conv", "ord", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "r")).select(
        "conv", "ord", "at", F.md5(F.concat(F.length("r.roles").cast("string"), F.lit(":"), "r.roles", "r.texts")).alias("h"))
    per = each.groupBy("conv", "ord", "h").agg(F.collect_list("at").alias("at"))
    least = per.groupBy("conv", "h").agg(F.min("ord").alias("least")).select(F.col("conv").alias("c"), F.col("h").alias("g"), "least")
    late = per.join(least, F.col("conv").eqNullSafe(F.col("c")) & (F.col("h") == F.col("g"))).where("ord > least")
    return late.groupBy("ord").agg(F.flatten(F.collect_list("at")).alias("seen"))


def _per_row(df: DataFrame, work, schema: str) -> DataFrame:
    """``work(row)`` (a dict) for each row, one batch at a time."""
    out = T._parse_datatype_string(schema)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                yield from _batches([work(r) for r in b.slice(at, 64).to_pylist()], out)

    return df.mapInArrow(run, out)


def _chain(tables):
    """Costs to go behind each block of a conversation, folded from its end."""
    import numpy as np

    vector, out = np.array(END), []
    for table in reversed(tables):
        out.append([int(x) for x in vector])
        vector = np.minimum(np.array(table).reshape(4, 4) + vector[None, :], NEVER).min(axis=1)
    return out[::-1]


def _long_conversations(open_: DataFrame) -> DataFrame:
    """The blocks of conversations that lie over several blocks, repaired: columns as of finished blocks, with the turn
    numbers kept."""
    known = open_.join(_seen_before(open_), "ord", "left")

    def read(r):
        initials, letters = _pattern(r["roles"], r["texts"], r["seen"] or ())
        faults = letters.translate(CLASSES)
        return {"ord": r["ord"], "initials": initials, "faults": faults, "table": cost_table(initials, faults),
                "blank": letters.count("b"), "duplicate": letters.count("d"), "truncated": letters.count("t"),
                "illegal": _illegal(initials)}

    read_ = cut_lineage(_per_row(known.select("ord", "roles", "texts", "seen"), read,
                                 "ord long, initials string, faults string, table array<long>, blank long, duplicate long, "
                                 "truncated long, illegal long"))
    names = open_.select("conv", "ord", *TURNS)
    light = names.join(read_.select("ord", "table"), "ord")

    def to_go(pdf):
        pdf = pdf.sort_values("ord")
        return pdf[["ord"]].assign(to_go=_chain(list(pdf["table"])))

    costs = light.groupBy("conv").applyInPandas(to_go, "ord long, to_go array<long>")

    def search(r):
        found = [cheapest(r["initials"], r["faults"], entry, r["to_go"]) for entry in range(4)]
        return {"ord": r["ord"], "exits": [f[2] for f in found], "audits": [f[1] for f in found], "costs": [f[0] for f in found]}

    searched = cut_lineage(_per_row(read_.select("ord", "initials", "faults").join(costs, "ord"), search,
                                    "ord long, exits array<long>, audits array<string>, costs array<long>"))

    def enter(pdf):
        pdf, entries, state = pdf.sort_values("ord"), [], 0
        first = int(pdf["costs"].iloc[0][0])
        for exits in pdf["exits"]:
            entries.append(state)
            state = int(exits[state])
        last = [False] * (len(pdf) - 1) + [True]
        return pdf[["ord"]].assign(entry=entries, last=last, end=END[state] // INSERT, cost=[first] + [0] * (len(pdf) - 1))

    entered = names.select("conv", "ord").join(searched.select("ord", "exits", "costs"), "ord").groupBy("conv").applyInPandas(
        enter, "ord long, entry long, last boolean, end long, cost long")
    # rows where one block meets the next: a pair of roles, a turn that goes on
    pairs = names.join(read_.select("ord", F.expr("substring(initials, 1, 1)").alias("head"),
                                    F.expr("right(initials, 1)").alias("tail"), "illegal"), "ord")
    chosen = (entered.join(searched.select("ord", "audits"), "ord").join(read_.drop("table", "initials", "faults", "illegal"), "ord")
              .join(_seams(pairs), "ord").join(open_.select("conv", "ord", "roles", "texts"), "ord"))

    def write(r):
        audit = r["audits"][r["entry"]] + "I" * (r["end"] if r["last"] else 0)
        roles, texts = apply_edits(audit, r["entry"], r["roles"], r["texts"])
        return {"ord": r["ord"], "roles": roles, "texts": texts, "audit": audit}

    done = _per_row(chosen.select("ord", "audits", "entry", "last", "end", "roles", "texts"), write,
                    "ord long, roles array<string>, texts array<string>, audit string")
    out = cut_lineage(chosen.select("conv", "ord", *TURNS, *COUNTS).join(done, "ord"))
    release(read_), release(searched)
    return out


def _seams(pairs: DataFrame) -> DataFrame:
    """(ord, turns, illegal and the other turn numbers) where a block's counts take the block before it into account."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv").orderBy("ord")  # one small row a block
    return (pairs.withColumn("before", F.lag("tail").over(w)).withColumn("turn_before", F.lag("turn_last").over(w))
            .select("ord", "turn_min", "turn_max", "turn_first", "turn_last",
                    (F.col("turns") - F.coalesce(F.col("turn_before") == F.col("turn_first"), F.lit(False)).cast("long")).alias("turns"),
                    (F.col("illegal") + F.coalesce(~F.concat("before", "head").isin(*LEGAL), F.lit(False)).cast("long"))
                    .alias("illegal")))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK, chars: int = BLOCK_CHARS) -> DataFrame:
    """The repaired conversations of ``df``, one row a block: ``conv``, ``ord`` (blocks of a conversation in order),
    ``closed`` (the block is the whole conversation), ``roles`` and ``texts`` of the rows that stay, ``audit`` of its
    edits, and counts that add up over a conversation: blank, duplicate, truncated, illegal, cost, turns (distinct turn
    numbers); turn_min and turn_max of its rows."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    blocks = cut_lineage(_blocks(rows, block, chars))
    cols = ["conv", "ord", "closed", "roles", "texts", "audit", *COUNTS, "turns", "turn_min", "turn_max"]
    long = _long_conversations(blocks.where("NOT closed")).withColumn("closed", F.lit(False))
    return blocks.where("closed").select(*cols).unionAll(long.select(*cols))


def report(repaired: DataFrame) -> DataFrame:
    """One row a conversation of ``repair``: conv, gaps, the counts, cost and audit."""
    total = [F.sum(c).alias(c) for c in COUNTS]
    per = repaired.groupBy("conv").agg(
        *total, F.min("turn_min").alias("lo"), F.max("turn_max").alias("hi"), F.sum("turns").alias("t"),
        F.sort_array(F.collect_list(F.struct("ord", "audit"))).alias("parts"))
    return per.select("conv", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("t"), F.lit(0)).alias("gaps"), *COUNTS,
                      F.array_join("parts.audit", "").alias("audit"))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired ``role:text`` lines. A hash goes from front to back: conversations of several
    blocks are sorted and streamed, a worker holds one block."""
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = repaired.where("closed").select("conv", F.sha2(lines, 256).alias("sha256"))
    parts = (repaired.where("NOT closed").select("conv", "ord", lines.alias("lines"), F.size("roles").alias("n"))
             .repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "ord"))
    out = whole.schema

    def run(batches):
        import hashlib

        conv, state, any_ = None, None, False
        for b in batches:
            for c, _, x, n in zip(*(col.to_pylist() for col in b.columns)):
                if state is not None and c != conv:
                    yield from _batches([{"conv": conv, "sha256": state.hexdigest()}], out)
                    state = None
                if state is None:
                    conv, state, any_ = c, hashlib.sha256(), False
                if n:
                    state.update((("\n" if any_ else "") + x).encode())
                    any_ = True
        if state is not None:
            yield from _batches([{"conv": conv, "sha256": state.hexdigest()}], out)

    return whole.unionAll(parts.mapInArrow(run, out))
