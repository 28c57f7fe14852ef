"""The registered queries of the operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table; its docstring says what the rows are where no contract does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import (bpe, centroids, cross_tokenizer, decontaminate, exact_dedup, licenses, line_dedup, lm, pii, simhash,
                            substring_dedup, token_counts, toxicity)
from tallyframe.llm.common import documents, prepare
from tallyframe.sources.tables import table

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
COUNT_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip_digests(documents(spark, sf_dir), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(documents(spark, sf_dir))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_score(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: contaminated, matching items, the smallest of them, matching windows."""
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the deleted ones, the digest of the text that is left."""
    return line_dedup.line_dedup_report(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: licence of the whole text, licences of its lines, canonical digest."""
    return licenses.license_scan(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(COUNT_FILE))


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer.alignment(documents(spark, sf_dir), public_tokenizers.path(COUNT_FILE), public_tokenizers.path(PIECE_FILE))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _prepared(q) for q in (
    op1_bpe, op2_substring_dedup, op3_lm_score, op4_simhash, op5_decontaminate, op6_line_dedup, op7_license_scan,
    op8_toxicity, op9_pii, op10_exact_dedup, op11_token_counts, op12_cross_tokenizer, op13_centroids)}

#: Operators that SQL can express; the tests hold the others against brute force.
ORACLE = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_license_scan": licenses.oracle(),
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op13_centroids": centroids.oracle(),
}
