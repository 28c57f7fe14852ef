"""Number extraction from free-text answers.

All parsers are built from ``regexp_extract_all`` + higher-order array
functions, so they run inside whole-stage codegen.  ``\\d`` is ASCII in the
JVM regex engine (and in DuckDB); that is the documented semantics here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.common import col_, strip_ws

DECIMAL_OR_INT = r"\d+\.\d+|\d+"
INTEGER = r"\d+"


def _mean_of(arr: Column) -> Column:
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return total / F.nullif(F.size(arr), F.lit(0))


def num_mean(c) -> Column:
    """Mean of all numbers (``d.d`` or ``d``) in ``lower(strip(s))``; none -> NULL.

    Neither case nor outer white space is part of a number, so the answer is read as it stands."""
    return _mean_of(F.regexp_extract_all(col_(c), F.lit(DECIMAL_OR_INT), 0))


def num_or_listcount(c) -> Column:
    """N1, else (no digits) the word count of a list-like answer.

    A list-like answer has at least ``words - 1`` separators (``,`` or ``-``)
    and more than one word.
    """
    s = F.lower(strip_ws(col_(c)))
    n_sep = F.size(F.regexp_extract_all(s, F.lit(r"[,-]"), 0))
    n_words = F.size(F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}_]+"), 0))
    fallback = F.when((n_sep >= n_words - 1) & (n_words > 1), n_words.cast("double"))
    return F.coalesce(num_mean(c), fallback)


def num_range(c) -> Column:
    """Range-aware integer parse; NULL or no digits -> 0.

    If the raw answer contains ``-`` or ``to`` the mean of all integers is
    returned, otherwise the first integer.
    """
    s = col_(c)
    ints = F.regexp_extract_all(s, F.lit(INTEGER), 0)
    is_range = s.contains("-") | s.contains("to")
    parsed = F.when(is_range, _mean_of(ints)).otherwise(F.get(ints, 0).cast("double"))
    return F.coalesce(parsed, F.lit(0.0))


def num_first(c) -> Column:
    """First run of digits as a number, else NULL."""
    first = F.regexp_extract(col_(c), r"(\d+)", 1)
    return F.when(first != "", first.cast("double"))


def num_strict(c) -> Column:
    """Commas removed, the whole string must be a number, else NULL.

    The pattern keeps out what a JVM cast would take besides (``1d``, ``5f``)."""
    s = F.regexp_replace(col_(c), ",", "")
    number = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
    return F.when(s.rlike(number), s.try_cast("double"))
