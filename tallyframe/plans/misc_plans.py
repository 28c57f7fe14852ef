"""Search bookkeeping and small model queries: W1, W2/S7, O3, M11, M27, M29."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import md5_bucket, round6
from tallyframe.operators import text as tx
from tallyframe.operators.labels import class_list, index_of, name_of
from tallyframe.operators.ordering import positions, running_max_before
from tallyframe.plans.oracle_views import bucket_sql, strip_sql, with_views, words_sql
from tallyframe.plans.registry import register
from tallyframe.sources import views


@register("running_best", with_views(
    "SELECT c, round(score, 6) AS score FROM (SELECT c, score, max(score) OVER (ORDER BY c ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM scores) WHERE prev IS NULL OR score > prev", "scores"))
def q_running_best(spark, sf_dir):
    """Rows that beat every earlier score (the running-best log)."""
    s = views.scores(spark, sf_dir).select("c", "score")
    r = running_max_before(s, ["c"], "score")
    return r.where(F.col("prev_max").isNull() | (F.col("score") > F.col("prev_max"))).select(
        "c", round6("score").alias("score"))


@register("best_candidate", with_views(
    "SELECT c, model, round(score, 6) AS score FROM scores ORDER BY score DESC, c LIMIT 1", "scores"))
def q_best_candidate(spark, sf_dir):
    """O3: top-1 by score, smallest id on ties (TakeOrderedAndProject)."""
    s = views.scores(spark, sf_dir)
    return s.orderBy(F.desc("score"), "c").limit(1).select("c", "model", round6("score").alias("score"))


_CUM_SQL = with_views("""
SELECT min(rk) AS k, CAST(any_value(total) AS BIGINT) AS total FROM (
  SELECT row_number() OVER (ORDER BY cnt DESC, token) AS rk,
         sum(cnt) OVER (ORDER BY cnt DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(cnt) OVER () AS total
  FROM (SELECT token, count(*) AS cnt FROM (SELECT unnest(""" + words_sql("text") + """) AS token FROM docs) GROUP BY token))
WHERE cum >= 0.5 * total""", "docs")


@register("cumshare_first_cross", _CUM_SQL)
def q_cumshare_first_cross(spark, sf_dir):
    """W1 on quantities: the fewest most-frequent words that cover half of
    all word occurrences.  Running sums come from weighted range-partition
    positions, not a single-partition window."""
    v = tx.vocabulary(tx.token_table(views.docs(spark, sf_dir))).withColumn("neg", -F.col("cnt"))
    r = positions(v, ["neg", "token"], name="start", weight="cnt")
    # the running share is monotone: the crossing row is the first one whose
    # cumulative count reaches half, so k = (rows still below half) + 1
    total = v.agg(F.sum("cnt").alias("total")).first()["total"]
    below = F.col("start") + F.col("cnt") < F.lit(0.5 * total)
    return r.agg((F.count_if(below) + 1).cast("bigint").alias("k"), F.lit(total).cast("bigint").alias("total"))


def _docs_train(spark, sf_dir):
    d = views.docs(spark, sf_dir)
    classes = class_list(d)
    rows = d.select("id", "text", index_of("label", classes).alias("y")).where(md5_bucket("id") < 8000)
    return classes, rows


_DOCS_TRAIN_CTES = [
    ("d", f"SELECT id, text, coalesce({strip_sql('label')}, '') AS label FROM docs"),
    ("cls", "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS y FROM (SELECT DISTINCT label FROM d)"),
    ("tr", f"SELECT d.id, d.text, cls.label, cls.y FROM d JOIN cls ON d.label = cls.label WHERE {bucket_sql('d.id')} < 8000"),
]

_MNB_SQL = with_views("""
SELECT g.token, g.label, round(ln((coalesce(c.n, 0) + 1.0) / (t.total + 1.0 * (SELECT count(*) FROM voc))), 6) AS log_theta
FROM (SELECT v.token, cls.label, cls.y FROM voc v CROSS JOIN cls) g
LEFT JOIN c ON c.token = g.token AND c.y = g.y
JOIN t ON t.y = g.y""", "docs", extra=_DOCS_TRAIN_CTES + [
    ("occ", f"SELECT id, y, unnest({words_sql('text')}) AS token FROM tr"),
    ("voc", "SELECT DISTINCT token FROM occ"),
    ("c", "SELECT token, y, count(*) AS n FROM occ GROUP BY token, y"),
    ("t", "SELECT cls.y, count(occ.token) AS total FROM cls LEFT JOIN occ ON occ.y = cls.y GROUP BY cls.y")])


@register("mnb_params", _MNB_SQL)
def q_mnb_params(spark, sf_dir):
    """Multinomial NB word log-probabilities with additive smoothing
    alpha = 1: ln((count_vk + a) / (sum_v count_vk + a V))."""
    from tallyframe.operators.nb import count_array
    classes, tr = _docs_train(spark, sf_dir)
    k, alpha = len(classes), 1.0
    occ = tx.token_table(tr, keep=["y"])
    counts = occ.groupBy("token").agg(count_array(F.col("y"), k).alias("n"))
    totals = occ.groupBy("y").count().collect()
    tot = {r[0]: r[1] for r in totals}
    v = counts.count()
    den = F.array(*[F.lit(float(tot.get(i, 0) + alpha * v)) for i in range(k)])
    lt = counts.select("token", F.posexplode(F.zip_with("n", den, lambda c, d: F.ln((c + alpha) / d))).alias("y", "lt"))
    return lt.select("token", name_of("y", classes).alias("label"), round6("lt").alias("log_theta"))


_CHI_SQL = with_views("""
SELECT v.token, round(sum((coalesce(c.n, 0) - v.fv * nk.nk / nt.n) * (coalesce(c.n, 0) - v.fv * nk.nk / nt.n)
                          / (v.fv * nk.nk / nt.n)), 6) AS chi2
FROM v CROSS JOIN nk CROSS JOIN nt LEFT JOIN c ON c.token = v.token AND c.y = nk.y
GROUP BY v.token""", "docs", extra=_DOCS_TRAIN_CTES + [
    ("pres", f"SELECT DISTINCT id, y, unnest({words_sql('text')}) AS token FROM tr"),
    ("c", "SELECT token, y, count(*) AS n FROM pres GROUP BY token, y"),
    ("v", "SELECT token, count(*) AS fv FROM pres GROUP BY token"),
    ("nk", "SELECT cls.y, count(tr.id) AS nk FROM cls LEFT JOIN tr ON tr.y = cls.y GROUP BY cls.y HAVING count(tr.id) > 0"),
    ("nt", "SELECT count(*) AS n FROM tr")])


@register("chi2_scores", _CHI_SQL)
def q_chi2_scores(spark, sf_dir):
    """Chi-squared score of each binary word feature against the class
    (observed = X^T Y counts, expected = feature count x class share)."""
    from tallyframe.operators.nb import class_counts, count_array
    classes, tr = _docs_train(spark, sf_dir)
    k = len(classes)
    nk = class_counts(tr.select("id", "y"), k)
    n = sum(nk)
    present = tx.token_table(tr, keep=["y"], distinct=True)
    counts = present.groupBy("token").agg(count_array(F.col("y"), k).alias("o"), F.count(F.lit(1)).alias("fv"))
    terms = []
    for i in range(k):
        if nk[i] == 0:
            continue
        e = F.col("fv") * F.lit(nk[i] / n)
        terms.append((F.get(F.col("o"), i) - e) * (F.get(F.col("o"), i) - e) / e)
    chi = terms[0]
    for t in terms[1:]:
        chi = chi + t
    return counts.select("token", round6(chi).alias("chi2"))


@register("baseline_uniform", with_views(
    f"SELECT s.id, cls.label AS pred_label FROM survey s JOIN cls ON {bucket_sql('s.id', seed=42, modulus=3)} = cls.y",
    "survey", extra=[("cls", "SELECT label, row_number() OVER (ORDER BY label) - 1 AS y FROM "
                             f"(SELECT DISTINCT coalesce({strip_sql('label')}, '') AS label FROM survey)")]))
def q_baseline_uniform(spark, sf_dir):
    """Each row gets one of the K classes from a seeded hash."""
    s = views.survey(spark, sf_dir)
    classes = class_list(s)
    return s.select("id", name_of(md5_bucket("id", len(classes), seed=42), classes).alias("pred_label"))
