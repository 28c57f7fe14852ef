"""Naive Bayes queries on the `docs` view."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import md5_bucket, round6
from tallyframe.operators import nb
from tallyframe.operators.labels import class_list, index_of, name_of
from tallyframe.plans.oracle_views import bucket_sql, strip_sql, with_views, words_sql
from tallyframe.plans.registry import register
from tallyframe.sources import views

TRAIN_BUCKETS = 8000  # 80 / 20 split on the md5 bucket


@dataclass
class NBRun:
    """Rows of a view; the fit and the scores are made when first asked for."""

    classes: list[str]
    rows: DataFrame      # (id, text, y, bucket)
    present: DataFrame   # distinct (id, y, bucket, token)
    a_class: float
    a: float
    b: float

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("bucket") < TRAIN_BUCKETS)

    @property
    def train_present(self) -> DataFrame:
        return self.present.where(F.col("bucket") < TRAIN_BUCKETS)

    @cached_property
    def prior(self) -> list[float]:
        counts = nb.class_counts(self.train, len(self.classes))
        return [(c + self.a_class) / (sum(counts) + len(counts) * self.a_class) for c in counts]

    @cached_property
    def model(self) -> nb.NBModel:
        return nb.fit(self.train_present, self.train.select("id", "y"), self.classes, self.a_class, self.a, self.b)

    @cached_property
    def scores(self) -> DataFrame:  # test rows: (id, y, s)
        return nb.score(self.present.where(F.col("bucket") >= TRAIN_BUCKETS), self.model, keep=["y"])


def labeled_rows(d: DataFrame, classes: list[str]) -> DataFrame:
    return d.select("id", "text", index_of("label", classes).alias("y"), md5_bucket("id").alias("bucket"))


def nb_run(spark, sf_dir, view=views.docs, a_class=1.0, a=1.0, b=3.0) -> NBRun:
    d = view(spark, sf_dir)
    classes = class_list(d)
    rows = labeled_rows(d, classes)
    present = nb.present_table(rows, keep=["y", "bucket"])
    return NBRun(classes, rows, present, a_class, a, b)


def nb_sql_ctes(view: str = "docs", a_class: float = 1.0, a: float = 1.0, b: float = 3.0) -> list[tuple[str, str]]:
    """DuckDB CTEs of the dense-grid NB fit and scoring (oracle side)."""
    return [
        ("d", f"SELECT id, text, coalesce({strip_sql('label')}, '') AS label, {bucket_sql('id')} AS bucket FROM {view}"),
        ("cls", "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS y FROM (SELECT DISTINCT label FROM d)"),
        ("dy", "SELECT d.id, d.text, d.bucket, cls.y FROM d JOIN cls ON d.label = cls.label"),
        ("pres", f"SELECT DISTINCT id, y, bucket, unnest({words_sql('text')}) AS token FROM dy"),
        ("nk", f"SELECT cls.y, count(dy.id) AS nk FROM cls LEFT JOIN dy ON cls.y = dy.y AND dy.bucket < {TRAIN_BUCKETS} GROUP BY cls.y"),
        ("ntot", "SELECT sum(nk) AS n, count(*) AS k FROM nk"),
        ("prior", f"SELECT y, (nk + {a_class}) / (n + k * {a_class}) AS pi FROM nk, ntot"),
        ("vocab", f"SELECT DISTINCT token FROM pres WHERE bucket < {TRAIN_BUCKETS}"),
        ("cnt", f"SELECT token, y, count(*) AS n FROM pres WHERE bucket < {TRAIN_BUCKETS} GROUP BY token, y"),
        ("theta", f"""SELECT v.token, nk.y, coalesce(c.n, 0) AS n, (coalesce(c.n, 0) + {a}) / (nk.nk + {a} + {b}) AS theta
                     FROM vocab v CROSS JOIN nk LEFT JOIN cnt c ON c.token = v.token AND c.y = nk.y"""),
        ("base", "SELECT p.y, ln(p.pi) + sum(ln(1 - t.theta)) AS base FROM prior p JOIN theta t ON p.y = t.y GROUP BY p.y, p.pi"),
        ("lo", "SELECT token, y, ln(theta) - ln(1 - theta) AS lo FROM theta"),
        ("test", f"SELECT id, y FROM dy WHERE bucket >= {TRAIN_BUCKETS}"),
        ("tpres", f"SELECT id, token FROM pres WHERE bucket >= {TRAIN_BUCKETS}"),
        ("s", """SELECT t.id, t.y AS truth, b.y, b.base + coalesce(sum(lo.lo), 0) AS s
                 FROM test t CROSS JOIN base b
                 LEFT JOIN tpres p ON p.id = t.id
                 LEFT JOIN lo ON lo.token = p.token AND lo.y = b.y
                 GROUP BY t.id, t.y, b.y, b.base"""),
        ("post", """SELECT id, truth, y, s, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS posterior
                   FROM (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM s)"""),
        ("pred", """SELECT id, truth, y AS pred FROM (
                      SELECT id, truth, y, row_number() OVER (PARTITION BY id ORDER BY s DESC, y) AS rn FROM s) WHERE rn = 1"""),
    ]


def _nb_sql(body: str, view: str = "docs", **kw) -> str:
    return with_views(body, view, extra=nb_sql_ctes(view, **kw))


@register("nb_prior", _nb_sql("SELECT cls.label, round(prior.pi, 6) AS pi FROM prior JOIN cls ON prior.y = cls.y"))
def q_nb_prior(spark, sf_dir):
    r = nb_run(spark, sf_dir)
    rows = [(c, round(p, 6)) for c, p in zip(r.classes, r.prior)]
    return spark.createDataFrame(rows, "label string, pi double")


def _long_theta(r: NBRun, col: str, alias: str, value=lambda c: c) -> DataFrame:
    t = nb.token_class_counts(r.train_present, len(r.classes)) if col == "n" else r.model.theta
    ex = t.select("token", F.posexplode(col).alias("y", "v"))
    return ex.select("token", name_of("y", r.classes).alias("label"), value(F.col("v")).alias(alias))


@register("nb_counts", _nb_sql("SELECT theta.token, cls.label, CAST(theta.n AS BIGINT) AS n FROM theta JOIN cls ON theta.y = cls.y"))
def q_nb_counts(spark, sf_dir):
    return _long_theta(nb_run(spark, sf_dir), "n", "n", lambda c: c.cast("bigint"))


@register("nb_theta", _nb_sql("SELECT theta.token, cls.label, round(theta.theta, 6) AS theta FROM theta JOIN cls ON theta.y = cls.y"))
def q_nb_theta(spark, sf_dir):
    return _long_theta(nb_run(spark, sf_dir), "theta", "theta", round6)


@register("nb_theta_rounded", _nb_sql("SELECT theta.token, cls.label, round(theta.theta, 7) AS theta FROM theta JOIN cls ON theta.y = cls.y"))
def q_nb_theta_rounded(spark, sf_dir):
    """The parameter sink's values (``%.7f``); ``sources.params`` writes them."""
    return _long_theta(nb_run(spark, sf_dir), "theta", "theta", lambda c: F.round(c, 7))


@register("nb_posterior", _nb_sql("SELECT post.id, cls.label, round(post.posterior, 6) AS posterior FROM post JOIN cls ON post.y = cls.y"))
def q_nb_posterior(spark, sf_dir):
    r = nb_run(spark, sf_dir)
    p = r.scores.select("id", F.posexplode(nb.softmax("s")).alias("k", "posterior"))
    return p.select("id", name_of("k", r.classes).alias("label"), round6("posterior").alias("posterior"))


@register("nb_predict", _nb_sql("SELECT pred.id, cls.label AS pred_label FROM pred JOIN cls ON pred.pred = cls.y"))
def q_nb_predict(spark, sf_dir):
    r = nb_run(spark, sf_dir)
    return r.scores.select("id", name_of(nb.argmax("s"), r.classes).alias("pred_label"))


ACC_SQL = """SELECT count(*) AS n_test, round(avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred"""


def accuracy(scored: DataFrame, pred: str = "pred", truth: str = "y") -> DataFrame:
    """One row (n_test, accuracy)."""
    hit = F.when(F.col(pred) == F.col(truth), 1.0).otherwise(0.0)
    return scored.agg(F.count(F.lit(1)).alias("n_test"), round6(F.avg(hit)).alias("accuracy"))


@register("nb_accuracy", _nb_sql(ACC_SQL))
def q_nb_accuracy(spark, sf_dir):
    return accuracy(nb.predict(nb_run(spark, sf_dir).scores))


@register("nb_accuracy_quality", _nb_sql(ACC_SQL, view="docs_quality"))
def q_nb_accuracy_quality(spark, sf_dir):
    """Second NB check: documents joined with quality labels (unbalanced)."""
    return accuracy(nb.predict(nb_run(spark, sf_dir, view=views.docs_quality).scores))
