"""Joins of rows with parameter tables whose size estimates can't be trusted.

Spark takes the size of a stored table for the size of what an explode makes of
it, so a plain join may broadcast the words of all rows to meet a few hundred
parameters.  Here rows are never the side that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a parameter table that may be broadcast; larger ones meet the rows by a shuffle.
BROADCAST_ROWS = 200_000


def join_parameters(rows: DataFrame, table: DataFrame, on: Sequence[str], count: int, how: str = "inner") -> DataFrame:
    """Join (inner or left) of rows with a table of at most ``count`` rows."""
    return rows.join(F.broadcast(table) if count <= BROADCAST_ROWS else table.hint("merge"), [*on], how)


def join_rows(keep: DataFrame, per: DataFrame, on: Sequence[str] = ("id",)) -> DataFrame:
    """Left join of two tables of rows, by a shuffle whatever their estimates."""
    return keep.join(per.hint("merge"), [*on], "left")
