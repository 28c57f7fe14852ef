"""Multi-select answers: domains, multi-hot, role maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.text import option_table


def option_long(df: DataFrame, cols: Sequence[str], id_col: str = "id",
                keep: Sequence[str] = ()) -> DataFrame:
    """(id, *keep, question, option): distinct options of each answer, all
    questions stacked (one scan, no union)."""
    parts = F.array(*[F.struct(F.lit(c).alias("question"), F.col(c).alias("answer")) for c in cols])
    st = df.select(F.col(id_col).alias("id"), *keep, F.explode(parts).alias("qa"))
    st = st.select("id", *keep, "qa.question", "qa.answer")
    return option_table(st, "answer", keep=[*keep, "question"])


def domain(df: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """(question, option) distinct, stripped, non-empty options.  The
    order is a presentation step; ``index_vocabulary`` gives indexes."""
    return option_long(df, cols, id_col).select("question", "option").distinct()


def multi_hot(df: DataFrame, dom: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """(id, question, option, value=1) for each chosen option that is
    in the domain (missing answer -> no option, see K3)."""
    return (option_long(df, cols, id_col)
            .join(dom.select("question", "option"), ["question", "option"], "left_semi")
            .withColumn("value", F.lit(1)))


def role_table(roles: dict[str, Sequence[str]], columns: Sequence[str], spark) -> DataFrame:
    """Invert ``{role: [columns]}`` to (question, role) for every column,
    'none' where a column has no role.  A configuration table."""
    inv = {c: r for r, cs in roles.items() for c in cs}
    return spark.createDataFrame([(c, inv.get(c, "none")) for c in columns], "question string, role string")
