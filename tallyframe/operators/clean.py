"""Cleaning: number parsing over whole tables, imputation, fills."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import num_mean, null_if_na_word

Parser = Callable[[Column], Column]


def normalise_na(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """S1 read semantics: NA words -> NULL on the given string columns."""
    return df.withColumns({c: null_if_na_word(c) for c in cols})


def parse_numbers(df: DataFrame, cols: Sequence[str], parser: Parser = num_mean,
                  suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": parser(F.col(c)) for c in cols})


def impute_fit(df: DataFrame, cols: Sequence[str], parser: Parser = num_mean,
               default: float = 1.0) -> DataFrame:
    """(question, impute_value) = mean of the parsed numbers; the
    default when a column has no number at all.  One aggregate pass."""
    means = df.agg(*[F.avg(parser(F.col(c))).alias(c) for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("question"),
                                           F.coalesce(F.col(c), F.lit(float(default))).alias("impute_value"))
                                  for c in cols]))
    return means.select(stacked.alias("s")).select("s.*")


def impute_apply(df: DataFrame, params: DataFrame, cols: Sequence[str],
                 parser: Parser = num_mean) -> DataFrame:
    """Parse and fill with the stored value.  The parameter table has one
    row per question (bounded), so it is read to the driver as literals."""
    values = {r["question"]: r["impute_value"] for r in params.collect()}
    return df.withColumns({c: F.coalesce(parser(F.col(c)), F.lit(float(values[c]))) for c in cols})


def missing_counts(df: DataFrame, cols: Sequence[str], parser: Parser = num_mean) -> DataFrame:
    """A4: (question, n_missing, n_rows) after parsing.  One pass."""
    aggs = [F.count_if(parser(F.col(c)).isNull()).alias(c) for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *aggs)
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("question"), F.col(c).cast("bigint").alias("n_missing"))
                             for c in cols]))
    return row.select(st.alias("s"), "_n").select("s.*", F.col("_n").alias("n_rows"))


def fill_constant(df: DataFrame, value: str = "0", cols: Sequence[str] | None = None) -> DataFrame:
    """Fill missing values with a constant."""
    cols = list(cols or df.columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in cols})
