"""Deterministic, engine-independent hash buckets (splits, folds, baselines).

``bucket = int(first 8 hex digits of md5(key)) % modulus``.  md5 is used
instead of ``xxhash64``/``rand`` because the same value can be computed in
any SQL engine, so a split is reproducible outside Spark and independent of
partitioning and row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.common import col_


def md5_key(c, seed: int | None = None) -> Column:
    key = col_(c).cast("string")
    if seed is not None:
        key = F.concat(F.lit(f"{seed}:"), key)
    return key


def md5_bucket(c, modulus: int = 10000, seed: int | None = None) -> Column:
    h = F.conv(F.substring(F.md5(md5_key(c, seed)), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(modulus)).cast("bigint")


def md5_order(c, seed: int | None = None) -> Column:
    """Full 32-bit hash value, used as a shuffle order key."""
    return F.conv(F.substring(F.md5(md5_key(c, seed)), 1, 8), 16, 10).cast("bigint")
