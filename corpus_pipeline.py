"""The corpus pipeline: five stages, each one operator of ``tallyframe.llm``.

``run`` writes every stage as Parquet into the shared folder and reads it
again for the next one, so that a lost executor costs no more than a stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from tallyframe.llm.common import prepare
from tallyframe.llm.queries import BPE_FILE
from tallyframe.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    prepare(spark)
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: ~toxicity.held_out(i))
    return toxicity.reject_toxic(docs, grammar)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that align with an earlier document go; all documents stay."""
    prepare(spark)
    return line_dedup.line_dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, decoded again; digests of both."""
    prepare(spark)
    return bpe.roundtrip_digests(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokenize),
]

#: Learned scores, alignments and components are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    home = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{i}")
        docs = spark.read.parquet(f"{home}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
