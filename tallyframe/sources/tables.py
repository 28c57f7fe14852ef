"""Parquet table loader.

Reads are lazy: Catalyst prunes the columns each query touches and pushes
its filters into the parquet scan, so a loader never ``select``s eagerly.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import ensure_checkpoint_dir

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_scans(spark: SparkSession, most: int) -> None:
    """From now on a scan task of this session reads at most ``most`` bytes of a file; a smaller setting stays.

    A task that deals its rows by a key holds them until they are sent, so what
    it reads bounds what it holds."""
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    if int(number) << 10 * "bkmgtp".index(unit[:1] or "b") > most:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(most))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to a scratch folder and read again: lineage cut, no cache to release."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
