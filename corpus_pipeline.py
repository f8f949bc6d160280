"""From raw documents to token ids: filter, dedup, mix, encode.

Each stage works on all documents that the stage before kept; its result is written as Parquet in
the shared folder and read again, so a lost executor costs tasks and not stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstats.llm.common import stored, table
from eventstats.llm.exact_dedup import BATCHES, DigestIndex, drop_copies
from eventstats.llm.mixing import apply_mix, mix
from eventstats.llm.ngram_join import drop_near_copies
from eventstats.llm.queries_models import fit_toxicity
from eventstats.llm.queries_tokens import digests
from eventstats.llm.toxicity import CUT, score_documents


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from the labels, does not call toxic."""
    score = "_" * (1 + max(len(c) for c in docs.columns)) + "score"  # no column of docs
    scored = score_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), docs.columns, score)
    return scored.filter(F.col(score) < CUT).drop(score)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text, white space aside."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return drop_copies(docs, DigestIndex(spark, buckets=buckets), batches=BATCHES)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return apply_mix(docs, mix(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: their number, and digests of the ids and of the decoded text."""
    return digests(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

#: SQL expresses neither the network nor the sampling nor the tokens; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
