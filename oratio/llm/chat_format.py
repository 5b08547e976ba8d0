"""Chat formatting by token-level assembly.

A conversation is laid out as ``<s>`` then, for each turn, ``<|turn|>`` role ``<|sep|>`` text ``<|end|>``, then ``</s>``.
Control marks are reserved ids above the vocabulary that are spliced between segments; roles and
texts are encoded on their own, so no text can merge with a mark or produce one. Control strings
inside a text are escaped (a backslash behind their first character, one more where some stand
there already), so the printed form is unambiguous too, and unescaping is exact.

``assemble`` gives one row per turn: position, ids, segment lengths, the loss mask from the prefix
sums of those lengths, and the running token offset in the conversation. ``read_back`` decodes such
rows and digests each conversation.

Scale: rows are dealt by ranges of (conversation, turn, role, start of text), so a conversation with a third of
all turns lies over as many partitions as its rows need. Each partition encodes its rows and counts turns and tokens
from where its part of a conversation begins; the first and the last conversation of a partition may go on next
door, so their parts (two rows a partition at most) are summed up in order and give each part its offsets and the conversation its
opening and closing mark. Decoding is per row, without a shuffle. Only the digests of ``read_back`` go from front to
back, as SHA-256 does: decoded texts are sorted by conversation and streamed, a worker holds one batch.

Defined cases: a null text or role is empty; turns sort by (turn, role, text) with null turns first, so
repeated rows and ties have a fixed order; null conv_ids form one conversation; an empty
table gives an empty result; other columns are ignored. Formatted rows that lack their marks raise an error.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut_lineage
from .tokens import load_tokenizer

# Reserved ids, counted from the size of the vocabulary.
CONTROLS = ["<s>", "</s>", "<|turn|>", "<|sep|>", "<|end|>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "<|endoftext|>"]
BOS, EOS, TURN, SEP, END = range(5)
LOSS_ROLES = ("assistant",)

_ESCAPE = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS))
_UNESCAPE = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def _encoder(path: str):
    tok = load_tokenizer(path, plain=True)  # a special string in a text is ordinary text
    return tok, tok.get_vocab_size()


ASSEMBLED = ["conv_id", "position", "first", "last", "ids", "segments", "loss", "token_start"]
BODIES = ("conv_id long, part long, at long, before long, size long, tail boolean, edge boolean, ids binary, segments array<int>, "
          "loss array<boolean>, bos binary, eos binary")
SLICE = 256  # rows encoded at a time


def _bodies(df: DataFrame, path: str, loss_roles) -> DataFrame:
    """One row a turn without the marks around a conversation; ``at`` and ``before`` count the turns and tokens of the
    conversation from where it begins in the partition ``part``, ``edge`` marks the last row of a conversation that the
    partition may hold a part of only."""
    sort = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    rows = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(*sort, F.substring("text", 1, 64)).sortWithinPartitions(*sort, "text")
    loss_roles = tuple(loss_roles)
    schema = to_arrow_schema(T._parse_datatype_string(BODIES))

    def run(batches):
        from pyspark import TaskContext

        tok, base = _encoder(path)
        part = TaskContext.get().partitionId()
        mark = [np.array([base + i], "<u4") for i in range(len(CONTROLS))]

        def encode(texts):
            return [np.array(e.ids, "<u4") for e in tok.encode_batch_fast([escape(x) for x in texts], add_special_tokens=False)]

        def body(conv, role, role_ids, text_ids):
            parts = [mark[TURN], role_ids, mark[SEP], text_ids, mark[END]]
            n = np.array([len(p) for p in parts])
            ends = np.cumsum(n)  # the mask covers ids between two prefix sums
            mask = np.zeros(ends[-1], dtype=bool)
            if role in loss_roles:
                mask[ends[3] - n[3]:ends[3]] = True
            return {"conv_id": conv, "part": part, "at": 0, "before": 0, "size": int(ends[-1]), "tail": False, "edge": False,
                    "ids": np.concatenate(parts).astype("<u4").tobytes(), "segments": n.tolist(), "loss": mask.tolist(),
                    "bos": None, "eos": None}

        def close(row, edge):
            row["tail"], row["edge"], row["eos"] = True, edge, mark[EOS].tobytes()

        held, opening = None, True
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                b = whole.slice(start, SLICE)
                conv, _, role, text = (c.to_pylist() for c in b.columns)
                ready = []
                for row in map(body, conv, role, encode(role), encode(text)):
                    if held is None or held["conv_id"] != row["conv_id"]:
                        row["bos"] = mark[BOS].tobytes()
                        if held is not None:
                            close(held, opening)
                            opening = False
                    else:
                        row["at"], row["before"] = held["at"] + 1, held["before"] + held["size"]
                    if held is not None:
                        ready.append(held)
                    held = row
                if ready:
                    yield pa.RecordBatch.from_pylist(ready, schema=schema)
        if held is not None:
            close(held, True)
            yield pa.RecordBatch.from_pylist([held], schema=schema)

    return dealt.mapInArrow(run, BODIES)


def assemble(df: DataFrame, path: str, loss_roles=LOSS_ROLES) -> DataFrame:
    """Formatted turns (columns ``ASSEMBLED``): one row per turn, ``position`` in conversation order."""
    bodies = cut_lineage(_bodies(df, path, loss_roles))
    ahead = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = bodies.where("edge").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), (F.col("at") + 1).alias("turns"),
                                        (F.col("before") + F.col("size")).alias("tokens"))
    parts = parts.select("c", "p", F.sum("turns").over(ahead).alias("turns"), F.sum("tokens").over(ahead).alias("tokens"),
                         F.lead("p").over(Window.partitionBy("c").orderBy("p")).isNotNull().alias("goes_on"))
    # at most two rows a partition
    rows = bodies.join(F.broadcast(parts), (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    first = F.col("bos").isNotNull() & F.col("turns").isNull()
    last = F.col("tail") & ~F.coalesce("goes_on", F.lit(False))
    rows = rows.withColumn("first", first).withColumn("last", last).withColumn(
        "position", F.col("at") + F.coalesce("turns", F.lit(0)))
    return rows.select(
        "conv_id", "position", "first", "last",
        F.expr("concat(if(first, bos, X''), ids, if(last, eos, X''))").alias("ids"),
        F.expr("concat(if(first, array(1), cast(array() AS array<int>)), segments, if(last, array(1), cast(array() AS array<int>)))")
        .alias("segments"),
        F.expr("concat(if(first, array(false), cast(array() AS array<boolean>)), loss, "
               "if(last, array(false), cast(array() AS array<boolean>)))").alias("loss"),
        # behind the first turn stands the opening mark as well
        (F.col("before") + F.coalesce("tokens", F.lit(0)) + (F.col("position") > 0).cast("long")).alias("token_start"))


def segments_of(ids: np.ndarray, base: int) -> list:
    """Formatted ids cut at the reserved ids: ints for marks, arrays for what stands between."""
    cuts = np.flatnonzero(ids >= base)
    out, at = [], 0
    for c in cuts:
        out.append(ids[at:c])
        out.append(int(ids[c]) - base)
        at = c + 1
    out.append(ids[at:])
    return out


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "n_tokens long, loss_tokens long")


DECODED = ("conv_id long, position long, role string, text string, loss string, loss_is_text boolean, formatted_chars long, "
           "n_tokens long, loss_tokens long")


def decode(assembled: DataFrame, path: str) -> DataFrame:
    """Each formatted turn read from its ids and its loss mask: role, text, and ``loss``, the text under the mask, which is
    null where there is none or where it is the turn's text (``loss_is_text``)."""
    schema = to_arrow_schema(T._parse_datatype_string(DECODED))

    def run(batches):
        tok, base = _encoder(path)

        def text(ids):
            return tok.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

        def read(conv, position, raw, loss):
            ids, mask = np.frombuffer(raw, "<u4"), np.array(loss, dtype=bool)
            parts = segments_of(ids, base)
            marks = [p for p in parts if isinstance(p, int)]
            if marks[int(marks[:1] == [BOS]):][:3] != [TURN, SEP, END]:
                raise ValueError(f"a formatted turn is damaged: conversation {conv}, position {position}")
            turn_at = next(i for i, x in enumerate(parts) if isinstance(x, int) and x == TURN)
            role, content = text(parts[turn_at + 1]), text(parts[turn_at + 3])
            plain, under = unescape(content), ids[mask]
            learned = unescape(text(under))
            same = bool(len(under)) and learned == plain
            return {"conv_id": conv, "position": position, "role": unescape(role), "text": plain,
                    "loss": learned if len(under) and not same else None, "loss_is_text": same,
                    "formatted_chars": len(role) + len(content) + sum(len(CONTROLS[m]) for m in marks),
                    "n_tokens": len(ids), "loss_tokens": len(under)}

        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                b = whole.slice(start, SLICE)
                rows = [read(*r) for r in zip(*(c.to_pylist() for c in b.columns))]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return assembled.select("conv_id", "position", "ids", "loss").mapInArrow(run, DECODED)


def read_back(assembled: DataFrame, path: str) -> DataFrame:
    """Digest of each conversation, decoded from the formatted ids and the loss mask alone."""
    dealt = decode(assembled, path).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "position")
    schema = to_arrow_schema(T._parse_datatype_string(DIGEST))

    def run(batches):
        def close(s):
            return {k: v.hexdigest() if k.endswith("sha256") else v for k, v in s.items()}

        state = None
        for b in batches:
            done = []
            for conv, _, role, text, loss, is_text, formatted, tokens, under in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or state["conv_id"] != conv:
                    if state is not None:
                        done.append(close(state))
                    state = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0,
                             "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "n_tokens": 0, "loss_tokens": 0}
                state["n_turns"] += 1
                state["turns_sha256"].update(f"{role}\n{text}\n".encode())
                learned = text if is_text else loss or ""
                state["loss_chars"] += len(learned)
                state["loss_sha256"].update(learned.encode())
                state["formatted_chars"] += formatted
                state["n_tokens"] += tokens
                state["loss_tokens"] += under
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([close(state)], schema=schema)

    return dealt.mapInArrow(run, DIGEST)
