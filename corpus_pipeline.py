"""Corpus pipeline: quality rules, near-duplicates, repeated passages, mixture, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame that
the driver of the pipeline writes as Parquet and reads back as the next stage's ``docs``; all but the last
return the columns of ``documents``. ``run`` applies them to the whole documents table.
"""

from __future__ import annotations

from oratio.llm import fm_dedup, mixing, packing, quality_rules, simhash
from oratio.llm.common import cut_lineage, table
from oratio.llm.tokens import default_path

# Packing has no SQL form; the pipeline is tested against plain Python (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that pass the rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def repeated_passages(spark, docs, sf_dir):
    """Texts without the passages that start in an earlier document."""
    return fm_dedup.without_repeats(docs)


def mixture(spark, docs, sf_dir):
    """Documents as often as the mixture takes them."""
    return mixing.expand(docs)


def packed(spark, docs, sf_dir):
    """Training sequences: the pieces of the packed corpus."""
    return packing.digest(packing.pack(docs, default_path(), end_id=1))


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
