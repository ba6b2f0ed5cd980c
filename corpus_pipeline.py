"""The corpus pipeline: five stages, each a table of documents for the next.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, all but
the last with the columns of ``documents``. ``run`` writes each
stage's rows as Parquet below the shared checkpoint folder and reads them back.
"""

from __future__ import annotations

import uuid

from tidings.llm import exact_dedup, mixing, packing, quality, simhash
from tidings.session import scratch_path
from tidings.sources.tables import table


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark, docs, sf_dir):
    """Of each SimHash component the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents are sampled by the raked probabilities of their cell."""
    return mixing.sample(docs)


def packing_stage(spark, docs, sf_dir):
    """Pieces placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The classifier and the 64-bit hash have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; the last stage's rows."""
    docs, at = table(spark, sf_dir, "documents"), scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs
