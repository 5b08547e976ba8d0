"""Spark SQL expression text for the large generated expressions.

Lexicon tests expand to one term per phrase; building them through the Column API costs
several driver-JVM round trips per term. Writing them as SQL text and parsing the whole
expression once (``F.expr``) gives the same plan for a fraction of the planning time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(s: str) -> str:
    """Spark SQL string literal (backslash escapes, as the parser reads them by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def hits(lc: str, lexicon) -> list[str]:
    """Per category: number of its phrases that occur in the lower-cased text ``lc``."""
    return ["(" + " + ".join(f"CAST(contains({lc}, {lit(p)}) AS INT)" for p in ps) + ")" for _, ps in lexicon]


def predominant(hit_exprs: list[str], lexicon) -> str:
    """Category with most hits, ties to the earlier category, null when none."""
    top = f"greatest({', '.join(hit_exprs)})" if len(hit_exprs) > 1 else hit_exprs[0]
    whens = " ".join(f"WHEN {h} = {top} AND {h} > 0 THEN {lit(c)}" for (c, _), h in zip(lexicon, hit_exprs))
    return f"CASE {whens} END"


def any_phrase(lc: str, lexicon) -> str:
    return "(" + " OR ".join(f"contains({lc}, {lit(p)})" for _, ps in lexicon for p in ps) + ")"


def title(key: str) -> str:
    """Display label of a category key in title case (as ``initcap`` gives it)."""
    return " ".join(w[:1].upper() + w[1:].lower() for w in key.replace("_", " ").split(" "))


def expr(sql: str) -> Column:
    return F.expr(sql)
