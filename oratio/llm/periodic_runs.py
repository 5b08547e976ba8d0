"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words whose smallest period is q (words q apart are equal), which no
neighbouring word extends keeping the period, and which is at least ``min_length`` words and ``min_exponent``
periods long.

A text's words become integers. The suffix array comes from prefix doubling (only groups that are not yet
single are sorted again), the LCP of neighbours from the ranks of each doubling. Every LCP value with its
nearest smaller values gives an LCP interval [lb, rb] of depth d, found without tree nodes. A square of
period d whose next word breaks the period has its two halves in different children of an interval of depth d,
so for the suffixes i of all children but the largest it is enough to look up ISA[i + d] and ISA[i - d]:
inside the interval, in another child, is a branching square. There are O(n log n) such look-ups. Every run
ends in exactly one branching square of its smallest period; rotating that square to the left as long as the
period holds gives the run's start. A square whose root is itself a repetition ends where a run of a divisor
of its period ends, and is merged into that run.

The words of one text are numbered apart from those of all others, so several texts share one suffix array
(``SLICE`` words at a time, or one longer text) and no square crosses from one text to the next.

Scale: one pass, no shuffle; a worker holds one Arrow batch and O(w log w) integers for the w words of a slice.

Defined cases: a null or wordless text has no words, no runs and an empty collapsed text; repeated rows are
treated alike; all other columns, whatever their names, are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name

MIN_LENGTH = 24
MIN_EXPONENT = 3
SLICE = 1 << 16


def suffix_ranks(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``ids`` and, for j = 0, 1, .., the ranks of all positions by their first 2**j
    numbers (equal ranks: equal prefixes), with -1 behind the end."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    at = np.arange(n)
    new = np.ones(n, dtype=bool)
    new[1:] = ids[order[1:]] != ids[order[:-1]]
    rank = np.full(n + 1, -1, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    levels = [rank]
    open_ = _members(order, new)
    step = 1
    while len(open_):
        group, follow = rank[open_].astype(np.int64), rank[np.minimum(open_ + step, n)]
        o = np.argsort(group * (n + 1) + follow + 1, kind="stable")
        open_, group, follow = open_[o], group[o], follow[o]
        at = np.arange(len(open_))
        first = np.ones(len(open_), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        new = first.copy()
        new[1:] |= follow[1:] != follow[:-1]
        place = group + at - np.maximum.accumulate(np.where(first, at, 0))
        rank = rank.copy()
        rank[open_] = np.maximum.accumulate(np.where(new, place, 0))
        levels.append(rank)
        open_ = _members(open_, new)
        step *= 2
    sa = np.empty(n, dtype=np.int64)
    sa[rank[:n]] = np.arange(n)
    return sa, levels


def _members(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The positions of ``order`` in groups of two or more; ``new`` marks the first of each group."""
    sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
    return order[np.repeat(sizes > 1, sizes)]


def neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[i]: common words of the suffixes sa[i - 1] and sa[i]; lcp[0] and the one behind the end are 0."""
    n = len(sa)
    lcp = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(levels[0][sa[:-1]] == levels[0][sa[1:]]) + 1
    a, b = sa[at - 1].copy(), sa[at].copy()
    for j in range(len(levels) - 1, -1, -1):
        same = levels[j][a] == levels[j][b]
        lcp[at[same]] += 1 << j
        a[same] += 1 << j
        b[same] += 1 << j
    return lcp


def _nearest_smaller(value: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each index of ``at`` the nearest index in direction ``step`` with a smaller value (the ends are
    0, below every value asked for). Pointers jump along pointers: all they pass is at least as great."""
    jump = np.arange(len(value)) + step
    todo = at
    while len(todo):
        todo = todo[value[jump[todo]] >= value[todo]]
        jump[todo] = jump[jump[todo]]
    return jump[at]


def branching_squares(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares whose period breaks at the word behind them."""
    n = len(ids)
    none = np.zeros(0, dtype=np.int64)
    if n < 2:
        return none, none
    sa, levels = suffix_ranks(ids)
    isa = levels[-1][:n].astype(np.int64)
    lcp = neighbour_lcp(sa, levels)
    split = np.flatnonzero(lcp)
    if not len(split):
        return none, none
    lb, end, depth = _nearest_smaller(lcp, split, -1), _nearest_smaller(lcp, split, 1), lcp[split]
    # splits of one interval side by side, in order; a child ends at each split, the last one at the end
    o = np.lexsort((split, depth, lb))
    split, lb, end, depth = split[o], lb[o], end[o], depth[o]
    last = np.ones(len(o), dtype=bool)
    last[:-1] = (lb[1:] != lb[:-1]) | (depth[1:] != depth[:-1])
    first = np.roll(last, 1)
    first[0] = True
    interval = np.cumsum(first) - 1
    lo = np.where(first, lb, np.roll(split, 1))
    child_lo, child_hi = np.concatenate([lo, split[last]]), np.concatenate([split, end[last]])
    owner = np.concatenate([interval, interval[last]])
    size = child_hi - child_lo
    most = np.zeros(interval[-1] + 1, dtype=np.int64)
    np.maximum.at(most, owner, size)
    great = np.flatnonzero(size == most[owner])
    spared = np.full(len(most), -1)
    spared[owner[great]] = great  # one largest child of each interval
    small = np.ones(len(size), dtype=bool)
    small[spared] = False
    child_lo, child_hi, owner, size = child_lo[small], child_hi[small], owner[small], size[small]
    whole_lo, whole_hi, depth = lb[first][owner], end[first][owner], depth[first][owner]
    member = np.repeat(np.arange(len(size)), size)
    suffix = sa[np.arange(len(member)) - np.repeat(np.cumsum(size) - size, size) + child_lo[member]]
    found = []
    for way in (1, -1):
        other = suffix + way * depth[member]
        ok = (other >= 0) & (other < n)
        m, s, other = member[ok], suffix[ok], other[ok]
        r = isa[other]
        hit = (r >= whole_lo[m]) & (r < whole_hi[m]) & ((r < child_lo[m]) | (r >= child_hi[m]))
        found.append(np.minimum(s[hit], other[hit]) * (n + 1) + depth[m[hit]])
    key = np.unique(np.concatenate(found))
    return key // (n + 1), key % (n + 1)


def _rotate_left(ids: np.ndarray, at: int, period: int) -> int:
    """The least start from which ``period`` holds up to ``at``: compared in growing pieces."""
    piece = 16
    while at > 0:
        lo = max(0, at - piece)
        differ = np.flatnonzero(ids[lo:at] != ids[lo + period:at + period])
        if len(differ):
            return lo + int(differ[-1]) + 1
        at, piece = lo, piece * 4
    return 0


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers, by start, then period."""
    start, period = branching_squares(ids)
    need = (min_exponent - 2) * period  # words that the square must rotate by at least
    ok = start >= need
    start, period, need = start[ok], period[ok], need[ok]
    near = np.minimum(need, 1)
    ok = (ids[start - need] == ids[start - need + period]) & (ids[start - near] == ids[start - near + period])
    start, period = start[ok], period[ok]
    by_end: dict[int, list[tuple[int, int]]] = {}
    runs = []
    for k in np.argsort(period, kind="stable"):
        q, end = int(period[k]), int(start[k] + 2 * period[k])
        known = by_end.setdefault(end, [])
        if any(q % p == 0 and end - s >= 2 * q for s, p in known):
            continue  # the root of this square is a repetition: merged into the run of the lesser period
        s = _rotate_left(ids, int(start[k]), q)
        known.append((s, q))
        if end - s >= max(min_length, min_exponent * q):
            runs.append((s, end - s, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _word_ids(words: list[bytes], first: int) -> tuple[list[int], int]:
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, first + len(seen)) for w in words]
    return ids, first + len(seen)


def _treat(texts: list[str | None], min_length: int, min_exponent: int):
    """(words, runs, collapsed text) of each text; texts share a suffix array up to ``SLICE`` words."""
    ids, spans, free = [], [], 0

    def flush():
        runs = find_runs(np.array(ids, dtype=np.int64), min_length, min_exponent) if ids else []
        at = 0
        for lo, words in spans:
            own = []
            while at < len(runs) and runs[at][0] < lo + len(words):
                own.append((runs[at][0] - lo, runs[at][1], runs[at][2]))
                at += 1
            if own:
                keep = np.ones(len(words), dtype=bool)
                for s, n, q in own:
                    keep[s + q:s + n] = False
                kept = [w for w, k in zip(words, keep) if k]
            else:
                kept = words
            yield len(words), own, b" ".join(kept).decode()

    for t in texts:
        words = (t or "").encode().split()  # bytes: only the six ASCII blanks separate words
        if spans and len(ids) + len(words) > SLICE:
            yield from flush()
            ids, spans, free = [], [], 0
        new, free = _word_ids(words, free)
        spans.append((len(ids), words))
        ids += new
    yield from flush()


def add_runs(df: DataFrame, text: str = "text", out: str = "repetition", min_length: int = MIN_LENGTH,
             min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``df`` with a struct under ``out`` (or the next free name): ``n_words``, ``runs`` (array of start,
    length, period in words, by start, then period) and ``collapsed`` (the words outside of runs and the first
    period of each run, joined by one space; a word inside a run behind its first period goes)."""
    if min_length < 1 or min_exponent < 2:
        raise ValueError("min_length must be 1 or more and min_exponent 2 or more")

    out = free_name(df, out)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])
    place = df.columns.index(text)

    def scan(batches):
        for batch in batches:
            rows = [{"n_words": n, "runs": [dict(zip(("start", "length", "period"), r)) for r in runs], "collapsed": kept}
                    for n, runs, kept in _treat(batch.column(place).to_pylist(), min_length, min_exponent)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(
        "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"))])
    return df.mapInArrow(scan, schema)
