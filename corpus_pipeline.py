"""Corpus pipeline: the documents table through five training-data stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written
as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trendstats.llm import decontam, pii, simhash, toxicity
from trendstats.llm.common import cut, read_table
from trendstats.llm.queries import mixed
from trendstats.session import ensure_checkpoint_dir, remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays (the smallest id)."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document for the target weights."""
    return mixed(docs, read_table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mix_sources", mix),
]

# Fingerprints, the classifier and boosted trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint
    folder and read again. A stage's folder goes once the next one is written;
    the last result is checkpointed."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = f"{folder}/{at}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                remove(spark, before)
            before = path
    docs = cut(docs)
    remove(spark, folder)
    return docs
