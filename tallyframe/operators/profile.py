"""Profiling: counts, exact quantiles, box plots, histograms, KDE, ANOVA,
pivots (A1-A11, P9, P10).

Exact quantiles never gather a group into one task: values are first
pre-aggregated to (group, value, count) (map-side combine absorbs hot
values), ranked with the range-partitioned ``positions``, and only the rows
that hold the needed ranks (groups x quantiles x 2, bounded) are joined.
"""


import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.ordering import group_join, positions


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Count by value (ordering is a presentation step: ``orderBy``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def non_null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P10: (column, dtype, non_null, n_rows) in one pass."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in cols])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                      F.col(c).alias("non_null")) for c in cols]))
    return row.select(st.alias("s"), "_n").select("s.*", F.col("_n").alias("n_rows"))


def exact_quantiles(df: DataFrame, value_col: str, qs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., q, value) with linear interpolation between closest ranks
    (pandas / ``percentile`` / ``quantile_cont`` semantics)."""
    g = list(group_cols)
    if not g:
        out = exact_quantiles(df.withColumn("_g", F.lit(0)), value_col, qs, ["_g"])
        return out.drop("_g")
    vals = (df.where(F.col(value_col).isNotNull())
            .groupBy(*g, F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    ranked = positions(vals, ["_v"], g, name="_start", weight="_c")
    sizes = vals.groupBy(*g).agg(F.sum("_c").alias("_n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    need = (sizes.select(*g, "_n", F.explode(qarr).alias("q"))
            .withColumn("_h", F.col("q") * (F.col("_n") - 1))
            .withColumn("_lo", F.floor("_h").cast("bigint"))
            .withColumn("_frac", F.col("_h") - F.col("_lo"))
            .withColumn("_hi", F.least(F.col("_lo") + 1, F.col("_n") - 1)))
    # Equi-join on the group with a range filter: each value row meets at most
    # |qs| rows; whether the need table is broadcast is left to its size.
    j = group_join(ranked, need, g)
    lo_hit = (F.col("_lo") >= F.col("_start")) & (F.col("_lo") < F.col("_start") + F.col("_c"))
    hi_hit = (F.col("_hi") >= F.col("_start")) & (F.col("_hi") < F.col("_start") + F.col("_c"))
    picked = (j.where(lo_hit | hi_hit)
              .groupBy(*g, "q", "_frac")
              .agg(F.max(F.when(lo_hit, F.col("_v"))).alias("_vlo"),
                   F.max(F.when(hi_hit, F.col("_v"))).alias("_vhi")))
    return picked.select(*g, "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("value"))


def quantile_columns(df: DataFrame, value_col: str, qs: dict[str, float],
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles as named columns, one row per group."""
    g = list(group_cols)
    q = exact_quantiles(df, value_col, list(qs.values()), g)
    aggs = [F.max(F.when(F.col("q") == F.lit(float(v)), F.col("value"))).alias(k) for k, v in qs.items()]
    return q.groupBy(*g).agg(*aggs) if g else q.agg(*aggs)


def describe(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """A3: count, mean, std (n-1), min, 25/50/75 % (exact, linear), max."""
    g = list(group_cols)
    if not g:
        return describe(df.withColumn("_g", F.lit(0)), value_col, ["_g"]).drop("_g")
    x = F.col(value_col)
    basic = df.groupBy(*g).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                               F.min(x).alias("min"), F.max(x).alias("max"))
    qs = quantile_columns(df, value_col, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, g)
    # both sides have one row per group
    return group_join(basic, qs, g, "left")


def boxplot_stats(df: DataFrame, value_col: str, group_cols: Sequence[str]) -> DataFrame:
    """A5: quartiles, whiskers at the furthest point inside 1.5 IQR, outlier count."""
    g = list(group_cols)
    qs = quantile_columns(df, value_col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, g)
    qs = (qs.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("_lof", F.col("q1") - 1.5 * F.col("iqr"))
          .withColumn("_hif", F.col("q3") + 1.5 * F.col("iqr")))
    x = F.col(value_col)
    j = group_join(df.where(x.isNotNull()), qs, g)
    inside = (x >= F.col("_lof")) & (x <= F.col("_hif"))
    return (j.groupBy(*g, "q1", "median", "q3", "iqr")
            .agg(F.min(F.when(inside, x)).alias("whisker_lo"),
                 F.max(F.when(inside, x)).alias("whisker_hi"),
                 F.count_if(~inside).cast("bigint").alias("n_outliers"),
                 F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, value_col: str, bins: int = 15) -> DataFrame:
    """Equal-width bins between min and max, last bin closed; empty
    bins present with 0.  (bin, lo, hi, n)."""
    x = F.col(value_col)
    mn, mx = df.agg(F.min(x), F.max(x)).first()
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (mx - mn) / bins
    idx = F.least(F.floor((x - F.lit(mn)) * F.lit(float(bins)) / F.lit(mx - mn)), F.lit(bins - 1)) \
        if mx > mn else F.lit(0)
    counts = df.where(x.isNotNull()).groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def kde(df: DataFrame, value_col: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE, Scott bandwidth ``h = std * n^(-1/5)``, grid of
    ``gridsize`` points over ``[min - cut h, max + cut h]``.

    Values are pre-aggregated to (value, count); each distinct value fans out
    to the ``gridsize`` grid points, a fixed number, and is summed map-side.
    """
    x = F.col(value_col)
    n, sd, mn, mx = df.agg(F.count(x), F.stddev_samp(x), F.min(x), F.max(x)).first()
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    h = sd * n ** (-0.2)
    lo, hi = mn - cut * h, mx + cut * h
    step = (hi - lo) / (gridsize - 1)
    vals = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    fan = vals.select("v", "c", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("i"))
    gx = F.lit(lo) + F.col("i") * F.lit(step)
    z = (gx - F.col("v")) / F.lit(h)
    dens = fan.groupBy("i").agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("k"))
    grid = df.sparkSession.range(gridsize).select(F.col("id").cast("int").alias("i"))
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    return (grid.join(dens, "i", "left")
            .select("i", (F.lit(lo) + F.col("i") * F.lit(step)).alias("x"),
                    (F.coalesce("k", F.lit(0.0)) * F.lit(norm)).alias("density")))


def counts_by_label(long_df: DataFrame, key: str, classes: list[str], label_col: str = "label") -> DataFrame:
    """(key, one count column per class) with 0 where absent.  The pivot
    values are given, so the schema is fixed and no extra job runs."""
    return (long_df.groupBy(key).pivot(label_col, classes).agg(F.count(F.lit(1)))
            .fillna(0, subset=classes)
            .select(key, *[F.col(c).cast("bigint").alias(c) for c in classes]))


def pivot_mean(df: DataFrame, rows: Sequence[str], pivot_col: str, values: list, value_col: str) -> DataFrame:
    """Mean by rows x pivot values; a missing cell stays NULL."""
    return df.groupBy(*rows).pivot(pivot_col, values).agg(F.avg(value_col))


def anova_table(df: DataFrame, value_col: str, label_col: str) -> DataFrame:
    """A10: one-way ANOVA F from one per-label aggregate (K rows).

    (f, df_between, df_within); the per-label table is tiny, so a global
    window over it is bounded.
    """
    x = F.col(value_col)
    per = (df.where(x.isNotNull()).groupBy(label_col)
           .agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.var_samp(x).alias("v")))
    allw = Window.partitionBy()
    per = (per.withColumn("_nt", F.sum("n").over(allw))
           .withColumn("_k", F.count(F.lit(1)).over(allw))
           .withColumn("_gm", F.sum(F.col("n") * F.col("m")).over(allw) / F.col("_nt")))
    out = per.agg(F.sum(F.col("n") * (F.col("m") - F.col("_gm")) ** 2).alias("ssb"),
                  F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
                  F.first("_nt").alias("_nt"), F.first("_k").alias("_k"))
    return out.select(((F.col("ssb") / (F.col("_k") - 1)) / (F.col("ssw") / (F.col("_nt") - F.col("_k")))).alias("f"),
                      (F.col("_k") - 1).cast("bigint").alias("df_between"),
                      (F.col("_nt") - F.col("_k")).cast("bigint").alias("df_within"))


# --- upper tail of the F distribution (regularised incomplete beta) ---------

def _betacf(a: float, b: float, x: float, itmax: int = 300, eps: float = 3e-16) -> float:
    """Continued fraction of the incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float | None, d1: float, d2: float) -> float | None:
    """P(F > f) for F(d1, d2) = I_{d2/(d2+d1 f)}(d2/2, d1/2)."""
    if f is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return None
    if f <= 0:
        return 1.0
    return betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def anova(df: DataFrame, value_col: str, label_col: str) -> DataFrame:
    """A10 with the p-value: the F row is one row, so its tail probability is
    computed by a vectorised pandas UDF on that single row."""
    from pyspark.sql.functions import pandas_udf
    import pandas as pd

    @pandas_udf(T.DoubleType())
    def p_value(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return pd.Series([f_sf(a, b, c) for a, b, c in zip(f, d1, d2)], dtype="float64")

    t = anova_table(df, value_col, label_col)
    return t.withColumn("p", p_value("f", F.col("df_between").cast("double"), F.col("df_within").cast("double")))
