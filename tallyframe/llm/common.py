"""Helpers shared by the operators: column picking, shared tables, batch bounds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import ensure_checkpoint_dir
from tallyframe.sources.tables import table

#: The separators of every word rule here; ``bytes.split()`` cuts at the same six.
SPACES = r"[\x20\x09-\x0D]"

#: Rows of an Arrow batch.  Bounds what a Python task holds of the input at once.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and bounded Arrow batches for the session."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, by exact spelling.

    Columns are taken by position, so further columns whose names clash (also
    in another case, or repeated) don't make a reference ambiguous; the first
    of equal names counts.
    """
    at = [df.columns.index(n) for n in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(n) for i, n in zip(at, names)))


def own_name(df: DataFrame, name: str) -> str:
    """A column name that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Key of a document row: its id and a digest of its text.

    Rows that agree in both are repeated rows and always get equal results.
    """
    return [F.col(doc_id), F.xxhash64(F.col(text))]


def bucket_of_id(doc_id: Column, buckets: int) -> Column:
    """crc32(doc_id as text) mod buckets; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(buckets)), F.lit(-1))


def shared(df: DataFrame) -> DataFrame:
    """df written once to the folder that all executors share, lineage cut."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet beside the checkpoints, and read again.

    For tables that grow with the corpus: compressed, unlike ``shared``.
    """
    spark = df.sparkSession
    prepare(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
