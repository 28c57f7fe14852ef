"""Splits and folds (X1-X7, W5, W6) from md5 hash buckets.

A split is a column, not a pair of DataFrames built from a shuffle: it is
reproducible, independent of partitioning and row order, and costs no
shuffle.  Exact-size variants use the range-partitioned ``positions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.hashing import md5_bucket
from tallyframe.operators.ordering import positions

BUCKETS = 10000


def hash_split(df: DataFrame, train_share: float = 0.8, id_col: str = "id", seed: int | None = None,
               name: str = "split") -> DataFrame:
    """X1/X2/X5: 'train' for buckets below ``train_share`` x 10000."""
    b = md5_bucket(id_col, BUCKETS, seed)
    return df.withColumn(name, F.when(b < int(round(train_share * BUCKETS)), "train").otherwise("test"))


def exact_split(df: DataFrame, train_share: float = 0.8, id_col: str = "id", seed: int | None = None,
                name: str = "split") -> DataFrame:
    """Exactly ``int(train_share * n)`` training rows, the first ones in
    hash order (ties on the bucket broken by id)."""
    b = md5_bucket(id_col, BUCKETS, seed)
    counts = dict(df.groupBy(b.alias("_b")).count().collect())  # BUCKETS rows at most
    left = int(train_share * sum(counts.values()))
    cut = 0
    while left >= counts.get(cut, 0) and cut < BUCKETS:
        left -= counts.get(cut, 0)
        cut += 1
    # the cut bucket's first ``left`` ids, found by one bounded sort of that bucket alone
    last = df.where(b == cut).select(id_col).orderBy(id_col).limit(left).agg(F.max(id_col)).first()[0] if left else None
    train = (b < cut) if last is None else ((b < cut) | ((b == cut) & (F.col(id_col) <= F.lit(last))))
    return df.withColumn(name, F.when(train, "train").otherwise("test"))


def kfold(df: DataFrame, k: int = 5, id_col: str = "id", seed: int | None = 42, name: str = "fold") -> DataFrame:
    """Shuffled k-fold as a fold column."""
    return df.withColumn(name, (md5_bucket(id_col, BUCKETS, seed) % k).cast("int"))


def stratified_folds(df: DataFrame, k: int = 5, label_col: str = "label", id_col: str = "id",
                     seed: int | None = 42, name: str = "fold") -> DataFrame:
    """Inside each class, rows in hash order are dealt to folds
    round-robin, so every fold has each class in proportion.  The position
    inside a class is computed without gathering the class in one task."""
    ranked = positions(df.withColumn("_b", md5_bucket(id_col, BUCKETS, seed)), ["_b", id_col], [label_col],
                       name="_pos")
    return ranked.withColumn(name, (F.col("_pos") % k).cast("int")).drop("_b", "_pos")


def head_rows(df: DataFrame, share: float, order_col: str = "id", name: str = "is_head") -> DataFrame:
    """Flag the first ``int(share * n)`` rows in ``order_col`` order."""
    n = df.count()
    ranked = positions(df, [order_col], name="_pos")
    return ranked.withColumn(name, F.col("_pos") < int(share * n)).drop("_pos")
