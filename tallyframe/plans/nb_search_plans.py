"""NB stacking and searches: M4, M20, M21, M22 (NB form)."""

from __future__ import annotations

import math
import random
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import md5_bucket, round6, tokens
from tallyframe.operators import nb
from tallyframe.operators.labels import class_list, index_of, name_of
from tallyframe.operators.text import token_table
from tallyframe.plans.oracle_views import bucket_sql, strip_sql, with_views, words_sql
from tallyframe.plans.registry import register
from tallyframe.sources import views
from tallyframe.sources.views import QUESTIONS


def log_uniform_candidates(n: int, lo: float, hi: float, seed: int = 42) -> list[tuple[float, float]]:
    """Seeded log-uniform (a, b) candidate grid (a driver-side parameter list)."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a = math.exp(r.uniform(math.log(lo), math.log(hi)))
        b = math.exp(r.uniform(math.log(lo), math.log(hi)))
        out.append((round(a, 4), round(b, 4)))
    return out


CANDIDATES = log_uniform_candidates(10, 0.1, 10.0)


def _docs_rows(spark, sf_dir):
    d = views.docs(spark, sf_dir)
    classes = class_list(d)
    rows = d.select("id", "text", index_of("label", classes).alias("y"), md5_bucket("id").alias("bucket"),
                    (md5_bucket("id", seed=42) % 5).cast("int").alias("cvfold"))
    return classes, rows


def _present(rows: DataFrame, fold: F.Column) -> DataFrame:
    # read by the counts and by the scores: tokenised once
    return token_table(rows.withColumn("fold", fold), keep=["y", "fold"], distinct=True, outer=True).persist()


def _search_sql(fold_expr: str, where: str, n_folds: int, cands, a_class: float = 1.0) -> list[tuple[str, str]]:
    vals = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(cands))
    return [
        ("d0", f"SELECT id, text, coalesce({strip_sql('label')}, '') AS label, {bucket_sql('id')} AS bucket, "
               f"{bucket_sql('id', seed=42)} % 5 AS cvfold FROM docs"),
        ("cls", "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS y FROM (SELECT DISTINCT label FROM d0)"),
        ("dy", f"SELECT d0.id, d0.text, cls.y, CAST({fold_expr} AS INTEGER) AS fold FROM d0 JOIN cls ON d0.label = cls.label WHERE {where}"),
        ("pres", f"SELECT DISTINCT id, y, fold, unnest({words_sql('text')}) AS token FROM dy"),
        ("folds", f"SELECT CAST(range AS INTEGER) AS f FROM range({n_folds})"),
        ("nkf", "SELECT fold, y, count(*) AS n FROM dy GROUP BY fold, y"),
        ("nktr", """SELECT fo.f, c.y, coalesce(sum(nkf.n) FILTER (WHERE nkf.fold <> fo.f), 0) AS nk
                    FROM folds fo CROSS JOIN cls c LEFT JOIN nkf ON nkf.y = c.y GROUP BY fo.f, c.y"""),
        ("ntr", "SELECT f, sum(nk) AS n, count(*) AS k FROM nktr GROUP BY f"),
        ("cnt", "SELECT token, fold, y, count(*) AS n FROM pres GROUP BY token, fold, y"),
        ("voc", "SELECT DISTINCT fo.f, c.token FROM folds fo JOIN cnt c ON c.fold <> fo.f"),
        ("ctr", """SELECT v.f, v.token, cl.y, coalesce(sum(c.n), 0) AS n FROM voc v CROSS JOIN cls cl
                   LEFT JOIN cnt c ON c.token = v.token AND c.y = cl.y AND c.fold <> v.f GROUP BY v.f, v.token, cl.y"""),
        ("cands", f"SELECT cand, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM (VALUES {vals}) t(cand, a, b)"),
        ("theta", """SELECT ctr.f, cands.cand, ctr.token, ctr.y, (ctr.n + cands.a) / (nktr.nk + cands.a + cands.b) AS theta
                     FROM ctr JOIN nktr ON ctr.f = nktr.f AND ctr.y = nktr.y CROSS JOIN cands"""),
        ("base", f"""SELECT t.f, t.cand, t.y, ln((nktr.nk + {a_class}) / (ntr.n + ntr.k * {a_class})) + sum(ln(1 - t.theta)) AS base
                    FROM theta t JOIN nktr ON t.f = nktr.f AND t.y = nktr.y JOIN ntr ON t.f = ntr.f
                    GROUP BY t.f, t.cand, t.y, nktr.nk, ntr.n, ntr.k"""),
        ("lo", "SELECT f, cand, token, y, ln(theta) - ln(1 - theta) AS lo FROM theta"),
        ("tst", "SELECT id, y AS truth, fold FROM dy"),
        ("s", """SELECT t.id, t.truth, t.fold, b.cand, b.y, b.base + coalesce(sum(lo.lo), 0) AS s
                 FROM tst t JOIN base b ON b.f = t.fold
                 LEFT JOIN pres p ON p.id = t.id
                 LEFT JOIN lo ON lo.f = t.fold AND lo.cand = b.cand AND lo.token = p.token AND lo.y = b.y
                 GROUP BY t.id, t.truth, t.fold, b.cand, b.y, b.base"""),
        ("pred", """SELECT id, truth, fold, cand, y AS pred FROM (
                      SELECT *, row_number() OVER (PARTITION BY id, cand ORDER BY s DESC, y) AS rn FROM s) WHERE rn = 1"""),
        ("acc", """SELECT cand, fold, count(*) AS n, sum(CASE WHEN pred = truth THEN 1 ELSE 0 END) AS hits
                   FROM pred GROUP BY cand, fold"""),
    ]


def _cands_df(spark, cands):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(cands)],
                                 "cand int, a double, b double")


_CV_SQL = with_views(
    "SELECT acc.cand, c.a, c.b, round(avg(acc.hits / acc.n), 6) AS cv_accuracy FROM acc JOIN cands c ON acc.cand = c.cand "
    "GROUP BY acc.cand, c.a, c.b", "docs", extra=_search_sql("cvfold", "bucket < 8000", 5, CANDIDATES))


@register("nb_cv_search", _CV_SQL)
def q_nb_cv_search(spark, sf_dir):
    """Every (a, b) candidate x 5 folds of the training split in one job."""
    classes, rows = _docs_rows(spark, sf_dir)
    tr = rows.where(F.col("bucket") < 8000)
    one = F.array(F.struct(F.lit(0).alias("cell"), F.array_distinct(tokens(F.col("text"))).alias("toks")))
    acc = nb.search_cells(tr.select("id", "y", F.col("cvfold").alias("fold"), one.alias("cells")), len(classes), 5, CANDIDATES, cells=1)
    per = acc.groupBy("cand").agg(round6(F.avg(F.col("hits") / F.col("n"))).alias("cv_accuracy"))
    # the candidate table is a bounded parameter list
    return per.join(F.broadcast(_cands_df(spark, CANDIDATES)), "cand").select("cand", "a", "b", "cv_accuracy")


_HO_SQL = with_views(
    "SELECT acc.cand, c.a, c.b, round(acc.hits / acc.n, 6) AS accuracy FROM acc JOIN cands c ON acc.cand = c.cand "
    "WHERE acc.fold = 0", "docs",
    extra=_search_sql("CASE WHEN bucket >= 8000 THEN 0 ELSE 1 END", "true", 2, CANDIDATES))


@register("nb_holdout_search", _HO_SQL)
def q_nb_holdout_search(spark, sf_dir):
    """M20 on one hold-out split: accuracy of each candidate on the test rows."""
    classes, rows = _docs_rows(spark, sf_dir)
    fold = F.when(F.col("bucket") >= 8000, 0).otherwise(1)
    present = _present(rows, fold)
    acc = nb.search(present, len(classes), 2, CANDIDATES,
                    rows=rows.select("id", "y", fold.alias("fold"))).where(F.col("fold") == 0)
    out = acc.select("cand", round6(F.col("hits") / F.col("n")).alias("accuracy"))
    return out.join(F.broadcast(_cands_df(spark, CANDIDATES)), "cand").select("cand", "a", "b", "accuracy")


_KF_SQL = with_views(
    "SELECT fold, n, round(hits / n, 6) AS accuracy FROM acc", "docs",
    extra=_search_sql("cvfold", "true", 5, [(1.0, 3.0)]))


@register("nb_kfold_scores", _KF_SQL)
def q_nb_kfold_scores(spark, sf_dir):
    """5-fold accuracy of NB (a=1, b=3); vocabulary refit in every fold."""
    classes, rows = _docs_rows(spark, sf_dir)
    present = _present(rows, F.col("cvfold"))
    acc = nb.search(present, len(classes), 5, [(1.0, 3.0)], rows=rows.select("id", "y", F.col("cvfold").alias("fold")))
    return acc.select("fold", "n", round6(F.col("hits") / F.col("n")).alias("accuracy"))


# --- per-question NB on the survey: stacked probabilities and subsets -------

STACKED = ["setting", "movie", "drink", "reminder", "hotsauce"]


def _survey_parts(spark, sf_dir, questions, a=1.0, b=3.0):
    # read by the classes, the fit and the scores: the view is built once, its answers are kept and not their words
    s = views.survey(spark, sf_dir).withColumn("bucket", md5_bucket("id")).select("id", "label", "bucket", *questions).persist()
    classes = class_list(s)
    rows = s.select("id", index_of("label", classes).alias("y"), "bucket",
                    F.explode(F.array(*[F.struct(F.lit(q).alias("question"), F.col(q).alias("text"))
                                        for q in questions])).alias("qt")).select("id", "y", "bucket", "qt.*")
    present = token_table(rows, keep=["y", "bucket", "question"], distinct=True, outer=True)
    train = F.col("bucket") < 8000
    labeled = s.where(train).select("id", index_of("label", classes).alias("y"))
    model = nb.fit_grouped(present.where(train), labeled, classes, "question", a=a, b=b)
    return classes, present, model


def _grouped_sql(questions, a=1.0, b=3.0, a_class=1.0):
    stack = " UNION ALL ".join(f"SELECT id, y, bucket, '{q}' AS question, {q} AS text FROM sy" for q in questions)
    return [
        ("cls", "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS y FROM "
                f"(SELECT DISTINCT coalesce({strip_sql('label')}, '') AS label FROM survey)"),
        ("sy", f"SELECT s.*, cls.y, {bucket_sql('s.id')} AS bucket FROM survey s JOIN cls "
               f"ON coalesce({strip_sql('s.label')}, '') = cls.label"),
        ("st", stack),
        ("pres", f"SELECT DISTINCT id, y, bucket, question, unnest({words_sql('text')}) AS token FROM st"),
        ("nk", "SELECT cls.y, count(sy.id) AS nk FROM cls LEFT JOIN sy ON cls.y = sy.y AND sy.bucket < 8000 GROUP BY cls.y"),
        ("ntot", "SELECT sum(nk) AS n, count(*) AS k FROM nk"),
        ("prior", f"SELECT y, (nk + {a_class}) / (n + k * {a_class}) AS pi FROM nk, ntot"),
        ("voc", "SELECT DISTINCT question, token FROM pres WHERE bucket < 8000"),
        ("cnt", "SELECT question, token, y, count(*) AS n FROM pres WHERE bucket < 8000 GROUP BY question, token, y"),
        ("theta", f"""SELECT v.question, v.token, nk.y, (coalesce(c.n, 0) + {a}) / (nk.nk + {a} + {b}) AS theta
                     FROM voc v CROSS JOIN nk LEFT JOIN cnt c ON c.question = v.question AND c.token = v.token AND c.y = nk.y"""),
        ("qbase", "SELECT question, y, sum(ln(1 - theta)) AS base FROM theta GROUP BY question, y"),
        ("lo", "SELECT question, token, y, ln(theta) - ln(1 - theta) AS lo FROM theta"),
        ("qs", "SELECT * FROM (VALUES " + ", ".join(f"('{q}', {i})" for i, q in enumerate(questions)) + ") t(question, qi)"),
        ("rowsq", "SELECT sy.id, sy.y AS truth, sy.bucket, qs.question, qs.qi FROM sy CROSS JOIN qs"),
        ("qpart", """SELECT r.id, r.truth, r.bucket, r.question, r.qi, c.y, coalesce(qb.base, 0) + coalesce(sum(lo.lo), 0) AS part
                    FROM rowsq r CROSS JOIN cls c
                    LEFT JOIN qbase qb ON qb.question = r.question AND qb.y = c.y
                    LEFT JOIN pres p ON p.id = r.id AND p.question = r.question
                    LEFT JOIN lo ON lo.question = r.question AND lo.token = p.token AND lo.y = c.y
                    GROUP BY r.id, r.truth, r.bucket, r.question, r.qi, c.y, qb.base"""),
    ]


_STACK_SQL = with_views("""
SELECT id, question, label, round(exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id, question), 6) AS prob
FROM (SELECT qp.id, qp.question, cls.label, qp.part + ln(prior.pi) AS s,
             max(qp.part + ln(prior.pi)) OVER (PARTITION BY qp.id, qp.question) AS m
      FROM qpart qp JOIN prior ON qp.y = prior.y JOIN cls ON qp.y = cls.y)""", "survey", extra=_grouped_sql(STACKED))


@register("nb_stacked", _STACK_SQL)
def q_nb_stacked(spark, sf_dir):
    """M4: per-question NB posteriors (fit on the training split) as K
    extra features for every row."""
    classes, present, model = _survey_parts(spark, sf_dir, STACKED)
    parts = nb.score_parts(present, model, "question", with_prior=True)
    p = parts.select("id", "question", F.posexplode(nb.softmax("part")).alias("k", "prob"))
    return p.select("id", "question", name_of("k", classes).alias("label"), round6("prob").alias("prob"))


_SUBSET_SQL = with_views("""
SELECT mask, count(*) AS n, round(avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (
  SELECT id, truth, mask, y AS pred, row_number() OVER (PARTITION BY id, mask ORDER BY s DESC, y) AS rn FROM (
    SELECT qp.id, qp.truth, m.mask, qp.y, ln(prior.pi) + sum(qp.part) AS s
    FROM qpart qp JOIN prior ON qp.y = prior.y
    JOIN masks m ON (m.mask >> qp.qi) & 1 = 1
    WHERE qp.bucket >= 8000
    GROUP BY qp.id, qp.truth, m.mask, qp.y, prior.pi))
WHERE rn = 1 GROUP BY mask""", "survey", extra=_grouped_sql(QUESTIONS) + [
    ("masks", f"SELECT CAST(range AS BIGINT) AS mask FROM range(1, {2 ** len(QUESTIONS)})")])


@register("nb_subset_search", _SUBSET_SQL)
def q_nb_subset_search(spark, sf_dir):
    """M22 (NB form): test accuracy of every non-empty question subset.

    Each row's per-question parts are computed once; every mask sums the parts
    of its questions, then argmax and one aggregate by mask."""
    classes, present, model = _survey_parts(spark, sf_dir, QUESTIONS)
    k, nq = len(classes), len(QUESTIONS)
    test = present.where(F.col("bucket") >= 8000)
    parts = nb.score_parts(test, model, "question", keep=["y"])
    # one column for each question and class: sums and comparisons are plain generated code
    cells = [(qi, q, c) for qi, q in enumerate(QUESTIONS) for c in range(k)]
    per_id = parts.groupBy("id", "y").agg(*[
        F.coalesce(F.max(F.when(F.col("question") == q, F.get("part", c))), F.lit(0.0)).alias(f"p{qi}_{c}") for qi, q, c in cells])
    dealt = per_id.select("y", *[f"p{qi}_{c}" for qi, _, c in cells], F.explode(F.sequence(F.lit(1), F.lit(2 ** nq - 1))).alias("mask"))
    sums = dealt.select("y", "mask", *[sum(
        (F.when(F.col("mask").bitwiseAND(1 << qi) != 0, F.col(f"p{qi}_{c}")).otherwise(0.0) for qi in range(nq)), F.lit(math.log(model.prior[c])))
        .alias(f"s{c}") for c in range(k)])
    # the largest sum is the row's own, and the first of equal ones
    own = [(F.col("y") == c) & reduce(and_, [F.col(f"s{c}") > F.col(f"s{o}") if o < c else F.col(f"s{c}") >= F.col(f"s{o}") for o in range(k)])
           for c in range(k)]
    ex = sums.select(F.col("mask").cast("bigint").alias("mask"), reduce(or_, own).cast("double").alias("hit"))
    return (ex.groupBy("mask")
            .agg(F.count(F.lit(1)).alias("n"), round6(F.avg("hit")).alias("accuracy")))
