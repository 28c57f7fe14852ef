"""Profiling queries (A1-A11) on `survey`, `measures` and `scores`."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import round6
from tallyframe.operators import categories as cat
from tallyframe.operators import profile
from tallyframe.operators.labels import class_list, clean_label
from tallyframe.plans.oracle_views import options_sql, strip_sql, with_views
from tallyframe.plans.registry import register
from tallyframe.sources import views


@register("label_counts", with_views("SELECT label, count(*) AS n FROM survey GROUP BY label", "survey"))
def q_label_counts(spark, sf_dir):
    """A1: count by label (descending order is a presentation step)."""
    return profile.value_counts(views.survey(spark, sf_dir), "label").orderBy(F.desc("n"), "label")


@register("complexity_counts", with_views("SELECT complexity, count(*) AS n FROM survey GROUP BY complexity", "survey"))
def q_complexity_counts(spark, sf_dir):
    """Rows by rating."""
    return profile.value_counts(views.survey(spark, sf_dir), "complexity")


@register("distinct_values", with_views("SELECT DISTINCT hotsauce FROM survey", "survey"))
def q_distinct_values(spark, sf_dir):
    """A2: distinct answers, missing included."""
    return views.survey(spark, sf_dir).select("hotsauce").distinct()


_DESC_COLS = ("count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, "
              "round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25, "
              "round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75, "
              "round(max(x), 6) AS max")


def _round_all(df, keep):
    return df.select(*keep, *[round6(c).alias(c) if c not in keep and c != "count" else F.col(c)
                              for c in df.columns if c not in keep])


@register("describe_numeric", with_views(f"SELECT {_DESC_COLS} FROM measures", "measures"))
def q_describe_numeric(spark, sf_dir):
    """A3: count, mean, std, min, exact quartiles, max."""
    return _round_all(profile.describe(views.measures(spark, sf_dir), "x"), [])


@register("describe_by_label", with_views(f"SELECT label, {_DESC_COLS} FROM measures GROUP BY label", "measures"))
def q_describe_by_label(spark, sf_dir):
    """A3 by label."""
    return _round_all(profile.describe(views.measures(spark, sf_dir), "x", ["label"]), ["label"])


_BOX_SQL = with_views("""
SELECT m.label, round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3, round(q.q3 - q.q1, 6) AS iqr,
       round(min(x) FILTER (WHERE x >= q.q1 - 1.5 * (q.q3 - q.q1) AND x <= q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_lo,
       round(max(x) FILTER (WHERE x >= q.q1 - 1.5 * (q.q3 - q.q1) AND x <= q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE x < q.q1 - 1.5 * (q.q3 - q.q1) OR x > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS n_outliers,
       count(*) AS n
FROM measures m JOIN q ON m.label = q.label WHERE x IS NOT NULL
GROUP BY m.label, q.q1, q.median, q.q3""", "measures", extra=[("q", """
SELECT label, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
FROM measures WHERE x IS NOT NULL GROUP BY label""")])


@register("boxplot_by_label", _BOX_SQL)
def q_boxplot_by_label(spark, sf_dir):
    """A5: box-plot statistics of a number by label."""
    b = profile.boxplot_stats(views.measures(spark, sf_dir), "x", ["label"])
    return b.select("label", *[round6(c).alias(c) for c in ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]],
                    "n_outliers", "n")


_HIST_SQL = with_views("""
SELECT g.bin, round(mn + g.bin * ((mx - mn) / 15), 6) AS lo, round(mn + (g.bin + 1) * ((mx - mn) / 15), 6) AS hi,
       coalesce(b.n, 0) AS n
FROM g CROSS JOIN mm LEFT JOIN b ON g.bin = b.bin""", "measures", extra=[
    ("mm", "SELECT min(x) AS mn, max(x) AS mx FROM measures"),
    ("b", "SELECT CAST(least(floor((x - mn) * 15.0 / (mx - mn)), 14) AS INTEGER) AS bin, count(*) AS n "
          "FROM measures, mm WHERE x IS NOT NULL GROUP BY 1"),
    ("g", "SELECT CAST(range AS INTEGER) AS bin FROM range(15)")])


@register("histogram15", _HIST_SQL)
def q_histogram15(spark, sf_dir):
    """15 equal-width bins, empty bins kept."""
    h = profile.histogram(views.measures(spark, sf_dir), "x", 15)
    return h.select("bin", round6("lo").alias("lo"), round6("hi").alias("hi"), "n")


_KDE_SQL = with_views("""
SELECT g.i, round(st.lo + g.i * st.step, 6) AS x,
       round(sum(v.c * exp(-0.5 * ((st.lo + g.i * st.step - v.v) / st.h) * ((st.lo + g.i * st.step - v.v) / st.h)))
             / (st.n * st.h * sqrt(2 * pi())), 6) AS density
FROM g CROSS JOIN st CROSS JOIN v
GROUP BY g.i, st.lo, st.step, st.n, st.h""", "measures", extra=[
    ("s0", "SELECT count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM measures"),
    ("s1", "SELECT n, sd * pow(n, -0.2) AS h, mn, mx FROM s0"),
    ("st", "SELECT n, h, mn - 3.0 * h AS lo, (mx + 3.0 * h - (mn - 3.0 * h)) / 199 AS step FROM s1"),
    ("v", "SELECT x AS v, count(*) AS c FROM measures WHERE x IS NOT NULL GROUP BY x"),
    ("g", "SELECT CAST(range AS INTEGER) AS i FROM range(200)")])


@register("kde_price", _KDE_SQL)
def q_kde_price(spark, sf_dir):
    """Gaussian KDE curve (Scott bandwidth, 200 points, cut 3)."""
    k = profile.kde(views.measures(spark, sf_dir), "x")
    return k.select("i", round6("x").alias("x"), round6("density").alias("density"))


_OPT_BY_LABEL = with_views(
    "SELECT option, " + ", ".join(f"count(*) FILTER (WHERE label = '{v}') AS \"{v}\"" for v in "FOP")
    + " FROM opts GROUP BY option", "survey",
    extra=[("opts", f"SELECT DISTINCT id, coalesce({strip_sql('label')}, '') AS label, "
                    f"unnest({options_sql('setting')}) AS option FROM survey")])


@register("option_by_label", _OPT_BY_LABEL)
def q_option_by_label(spark, sf_dir):
    """Multi-select options counted for each label, 0 where absent."""
    s = views.survey(spark, sf_dir)
    classes = class_list(s)
    s = s.withColumn("label", clean_label("label"))
    opts = cat.option_long(s, ["setting"], keep=["label"])
    return profile.counts_by_label(opts, "option", classes)


_ANOVA_SQL = with_views("""
SELECT round((sum(n * (m - gm) * (m - gm)) / (kk - 1)) / (sum((n - 1) * coalesce(v, 0)) / (nn - kk)), 6) AS f,
       CAST(kk - 1 AS BIGINT) AS df_between, CAST(nn - kk AS BIGINT) AS df_within
FROM per, tot GROUP BY kk, nn""", "measures", extra=[
    ("per", "SELECT label, count(x) AS n, avg(x) AS m, var_samp(x) AS v FROM measures WHERE x IS NOT NULL GROUP BY label"),
    ("tot", "SELECT sum(n) AS nn, count(*) AS kk, sum(n * m) / sum(n) AS gm FROM per")])


@register("anova_f", _ANOVA_SQL)
def q_anova_f(spark, sf_dir):
    """A10: one-way ANOVA F of a number across labels."""
    t = profile.anova_table(views.measures(spark, sf_dir), "x", "label")
    return t.select(round6("f").alias("f"), "df_between", "df_within")


@register("anova")
def q_anova(spark, sf_dir):
    """A10 with the p-value (upper tail of F; no SQL form)."""
    return profile.anova(views.measures(spark, sf_dir), "x", "label")


MODELS = ["click", "error", "purchase", "signup", "view"]
_PIVOT_SQL = with_views(
    "SELECT feature, feature_type, " + ", ".join(
        f"round(avg(score) FILTER (WHERE model = '{m}'), 6) AS \"{m}\"" for m in MODELS)
    + " FROM scores GROUP BY feature, feature_type", "scores")


@register("leaderboard_pivot", _PIVOT_SQL)
def q_leaderboard_pivot(spark, sf_dir):
    """Mean score by (feature, feature_type) x model; the models are
    those of the data, so none is left out."""
    s = views.scores(spark, sf_dir)
    models = [r[0] for r in s.select("model").where("model is not null").distinct().orderBy("model").collect()]
    pv = profile.pivot_mean(s, ["feature", "feature_type"], "model", models, "score")
    return pv.select("feature", "feature_type", *[round6(f"`{m}`").alias(m) for m in models])
