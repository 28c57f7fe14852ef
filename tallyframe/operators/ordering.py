"""Scalable row positions.

A ``row_number()`` window without ``partitionBy`` pulls every row into one
task, and one with a skewed ``partitionBy`` key pulls a third of the table
into one task.  Here the table is range-partitioned on (group, order), sorted
inside its partitions and written once with ``checkpoint()``.  From then on
partition number and place in the partition are facts of stored data: every
later pass sees the same ones, also after an executor is lost.  A row's
position is its place in its stretch of the group plus the group's rows in
earlier partitions, a table with one row for each (partition, group) that
occurs, at most partitions + groups of them.  The cost is one shuffle and one
sort, whatever the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PLACE_BITS = 33  # monotonically_increasing_id: partition number above, place below


def ordered(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """df in the global order of ``cols``, stored, with ``_pid`` and ``_place``."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).checkpoint()
    number = F.monotonically_increasing_id()
    return stored.withColumn("_pid", F.shiftright(number, _PLACE_BITS)).withColumn(
        "_place", number.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))


def _same(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of left's columns with right's, by name."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in names.items()])


def positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
              name: str = "pos", num_partitions: int | None = None,
              weight: str | None = None) -> DataFrame:
    """Add a 0-based ``name`` column: rank of each row inside its group.

    ``order_cols`` must make rows unique inside a group (add the id).  A null
    group is a group like any other.  With ``weight`` (a count column of
    pre-aggregated rows) the result is the weighted start rank: the sum of the
    weights of all earlier rows.
    """
    g = list(group_cols)
    rows = ordered(df, [*g, *order_cols], num_partitions)
    if weight:
        earlier = Window.partitionBy("_pid", *g).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_in", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
        stretch = F.sum(weight)
    else:
        rows = rows.withColumn("_in", F.col("_place"))
        stretch = F.count(F.lit(1))
    stretches = rows.groupBy("_pid", *g).agg(stretch.alias("_n"), F.min("_in").alias("_first"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = stretches.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)],
                               start.alias("_off"))
    keys = {"_pid": "_p"} | {c: f"_g{i}" for i, c in enumerate(g)}
    out = rows.join(offsets, _same(rows, offsets, keys))
    return out.select(*df.columns, (F.col("_in") + F.col("_off")).cast("bigint").alias(name))


def group_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group columns in which a null group meets a null group."""
    renamed = right.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(cols)})
    out = left.join(renamed, _same(left, renamed, {c: f"_k{i}" for i, c in enumerate(cols)}), how)
    return out.drop(*[f"_k{i}" for i in range(len(cols))])


def running_max_before(df: DataFrame, order_cols: Sequence[str], value: str, name: str = "prev_max",
                       num_partitions: int | None = None) -> DataFrame:
    """W2 building block: max of ``value`` over all earlier rows (NULL for the
    first row): the running max inside each stored partition, and the max of
    all earlier partitions (a table with one row per partition)."""
    rows = ordered(df, order_cols, num_partitions)
    local = Window.partitionBy("_pid").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_pid").agg(F.max(value).alias("_pm"))
               .select(F.col("_pid").alias("_p"), F.max("_pm").over(before).alias("_om")))
    rows = rows.withColumn("_lm", F.max(value).over(local))
    out = rows.join(offsets, rows["_pid"] == offsets["_p"])
    return out.select(*df.columns, F.greatest("_lm", "_om").alias(name))
