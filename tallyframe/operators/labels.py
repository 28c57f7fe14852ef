"""Label dimension and label encodings.

The class list is a bounded parameter: it is collected once (with a hard
cap) and then used as a literal map, so no join is needed to index labels.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.common import col_, strip_ws
from tallyframe.operators.ordering import positions

MAX_CLASSES = 10_000


def clean_label(c) -> Column:
    """Missing -> '', white space stripped."""
    return F.coalesce(strip_ws(col_(c)), F.lit(""))


def class_list(df: DataFrame, label_col: str = "label", max_classes: int = MAX_CLASSES) -> list[str]:
    """Sorted distinct cleaned labels (binary order); raises above the cap."""
    rows = (df.select(clean_label(label_col).alias("label")).distinct()
            .orderBy("label").limit(max_classes + 1).collect())
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes; not a classification label")
    return [r[0] for r in rows]


def index_of(c, classes: list[str]) -> Column:
    """Label -> 0-based index via a literal map (NULL for an unknown label)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable((lab, i) for i, lab in enumerate(classes))])
    return F.try_element_at(m, clean_label(c)).cast("int")


def name_of(idx, classes: list[str]) -> Column:
    """Index -> label name."""
    arr = F.array(*[F.lit(x) for x in classes])
    return F.try_element_at(arr, col_(idx).cast("int") + 1)


def label_index_table(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, label_idx) for the sorted distinct labels."""
    d = df.select(clean_label(label_col).alias("label")).distinct()
    return positions(d, ["label"], name="label_idx").withColumn("label_idx", F.col("label_idx").cast("int"))


def label_encode(df: DataFrame, cols: list[str], fill: str = "0", id_col: str = "id") -> DataFrame:
    """C4: fill missing with ``fill``, then replace each value by its index in
    the column's sorted distinct values.

    All columns are handled in one pass: the (column, value) pairs are
    stacked, their distinct values ranked per column with ``positions``
    (value domains can be large, e.g. free text), joined back on
    (column, value) and pivoted to one row per id again.  ``id_col`` must be
    unique; other columns are kept."""
    rest = [c for c in df.columns if c not in cols]
    stacked = df.select(F.col(id_col).alias("_id"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias("_v")) for c in cols]))
        .alias("_s")).select("_id", "_s._c", "_s._v")
    dom = positions(stacked.select("_c", "_v").distinct(), ["_v"], ["_c"], name="_code")
    coded = stacked.join(dom, ["_c", "_v"])
    wide = coded.groupBy("_id").agg(*[F.max(F.when(F.col("_c") == c, F.col("_code"))).alias(c) for c in cols])
    return df.select(*rest).join(wide, df[id_col] == wide["_id"]).drop("_id")


def one_hot_label(df: DataFrame, classes: list[str], label_col: str = "label",
                  prefix: str = "Label_") -> DataFrame:
    """One 0/1 column per class; the label column is replaced.  Labels are
    cleaned as the classes are, so a missing or padded one finds its column."""
    lab = clean_label(label_col)
    cols = [F.coalesce((lab == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in classes]
    return df.select(*[c for c in df.columns if c != label_col], *cols)
