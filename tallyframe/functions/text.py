"""Tokenisation and option splitting (T1, C1 building blocks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.common import col_, strip_ws

# A word is a maximal run of Unicode letters, Unicode numbers or '_' -- the
# Unicode meaning of ``\b\w+\b``.  The JVM's plain ``\w`` is ASCII only; it
# stands first, for it is told faster than the classes, which hold it.
WORD_PATTERN = r"[\w\p{L}\p{N}]+"

# The stop words of the feature generator.
STOP_WORDS = ["the", "and", "is", "a", "an", "of", "to", "in", "for", "on", "with", "at"]


def tokens(c) -> Column:
    """``array<string>`` of lower-cased words; NULL text -> empty array."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(col_(c)), F.lit(WORD_PATTERN), 0),
        F.array().cast("array<string>"),
    )


def split_options(c, sep: str = ",") -> Column:
    """C1 building block: split a multi-select answer, strip each option and
    drop empty options.  NULL -> empty array."""
    parts = F.split(F.coalesce(col_(c), F.lit("")), sep)
    stripped = F.transform(parts, lambda x: strip_ws(x))
    return F.filter(stripped, lambda x: x != "")
