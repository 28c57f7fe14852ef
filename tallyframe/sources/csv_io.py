"""CSV readers and writers (S1, S2, S6) and the running-best log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.common import NA_WORDS
from tallyframe.operators.ordering import running_max_before


def _string_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_survey_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """S1 (+P3): header CSV, every answer kept as a string, quoted fields may
    span lines; the NA words of a pandas reader become NULL; optional
    rename of long question headers to short names."""
    reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if columns:
        reader = reader.schema(_string_schema(columns))
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    df = df.withColumns({c: F.when(F.col(c).isin(NA_WORDS), F.lit(None).cast("string")).otherwise(F.col(c))
                         for c in df.columns})
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return df


def read_strings_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Every value a string, blanks kept as '' (no NA normalisation)."""
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("emptyValue", "").option("nullValue", "\u0000")
            .schema(_string_schema(columns)).csv(path)
            .fillna("", subset=list(columns)))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV without an index column (one file per partition)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def running_best_log(scores: DataFrame, order_col: str, score_col: str, path: str | None = None) -> DataFrame:
    """Rows whose score beats every earlier row; written as CSV when
    ``path`` is given (the whole score table is computed first, then logged)."""
    r = running_max_before(scores, [order_col], score_col)
    best = r.where(F.col("prev_max").isNull() | (F.col(score_col) > F.col("prev_max"))).drop("prev_max")
    if path:
        write_csv(best, path)
    return best
