"""Small shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a pandas CSV reader turns into a missing value
# (its default ``na_values``), plus the empty string.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c) -> Column:
    """Round a computed double to 6 places (stable value hashing)."""
    return F.round(col_(c).cast("double"), 6)


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing white space of any kind."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def null_if_na_word(c) -> Column:
    """Turn the NA words of a CSV reader into NULL (S1 semantics)."""
    c = col_(c)
    return F.when(c.isin(NA_WORDS), F.lit(None).cast("string")).otherwise(c)
