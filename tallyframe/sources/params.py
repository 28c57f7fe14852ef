"""Parameter tables (S3, S4, S8): fitted model state as parquet tables.

Each kind of parameter is its own table (priors, thetas by question,
weights, bias, vocabulary), written with ``partitionBy`` where a question
column exists, so a scorer reads only the questions it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_theta(theta_long: DataFrame, path: str, decimals: int = 7) -> None:
    """(question, token, label, theta) rounded like ``%.7f``, one
    partition directory per question."""
    (theta_long.withColumn("theta", F.round("theta", decimals))
     .write.mode("overwrite").partitionBy("question").parquet(path))


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, question: str | None = None) -> DataFrame:
    """S3: load a parameter table; with ``question`` only that partition is
    read (partition pruning)."""
    df = spark.read.parquet(path)
    return df.where(F.col("question") == question) if question is not None else df


def vocabulary_table(spark: SparkSession, words: dict[str, list[str]]) -> DataFrame:
    """(question, token, idx) from stored word lists, index = sorted position."""
    rows = [(q, w, i) for q, ws in words.items() for i, w in enumerate(sorted(ws))]
    return spark.createDataFrame(rows, "question string, token string, idx int")
