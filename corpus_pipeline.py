"""The training-data pipeline: quality bands, near-dedup, decontamination, PII, BPE.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of docs as they were.  Nulls: a null text fails the quality rules and goes with stage one; a null id
stays; repeated rows and ties are one group of copies, of which one row stays, that of smallest id, then of first place.  A very long text is held whole by
the task that reads it.  An empty table passes through as an empty one.  What a stage read is dropped once the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, pii, quality, similar, wordbpe
from quire.llm.common import drop, stage, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the base rules or the compression bands reject go."""
    return quality.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, with 5-word shingles and its links verified and completed to a Jaccard similarity >= 0.8: one document of each group stays, that of smallest id."""
    return similar.one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents in which windows of a benchmark item occur go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), least_items=1)


def sanitize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: personal data becomes labels, and terms that disclose it are removed."""
    return pii.sanitize(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: ids of each document."""
    return wordbpe.encode(docs)


STAGES = [("quality", rules), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", sanitize), ("bpe", tokens)]
#: SQL has no zstandard, fingerprints, or BPE; tests/llm/test_pipeline.py checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) after all stages over documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, fn in STAGES:
        docs, at = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop(spark, before)
        before = at
    return docs
