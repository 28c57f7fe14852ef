"""Leaderboard (M25): question x representation x model.

Every (question, representation) cell is an independent Naive Bayes model
over the same survey rows, so the whole grid -- all cells, all (a, b)
candidates, 5 CV folds and the held-out test score -- is one grouped
``nb.search_cells`` job.  Per cell the first best candidate by CV
accuracy is reported with its test accuracy, in the reference's result-row
schema (model_name, best_params, best_cv_score, test_score, feature,
feature_type).
"""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.functions import md5_bucket, num_mean, round6, split_options, tokens
from tallyframe.operators import nb
from tallyframe.operators.labels import class_list, index_of
from tallyframe.operators.search import role_candidates
from tallyframe.plans.nb_search_plans import CANDIDATES, _grouped_sql as grouped_sql
from tallyframe.plans.oracle_views import n1_sql, with_views, words_sql
from tallyframe.plans.registry import register
from tallyframe.sources import views
from tallyframe.sources.tables import stored
from tallyframe.sources.views import QUESTIONS

REPRESENTATIONS = ["numerical", "category", "text"]


def representation_tokens(question: str, rep: str):
    """Binary tokens of one answer under a representation: the parsed number
    (as one categorical token), the comma options, or the words."""
    c = F.col(question)
    if rep == "numerical":
        x = num_mean(c)
        return F.when(x.isNull(), F.array().cast("array<string>")).otherwise(
            F.array(F.concat(F.lit("n="), F.floor(x).cast("string"))))
    if rep == "category":
        return split_options(c)
    return tokens(c)


def leaderboard(spark, sf_dir, candidates=CANDIDATES, n_folds: int = 5):
    names = [f"{q}/{r}" for q in QUESTIONS for r in REPRESENTATIONS]
    cells = F.array(*[F.struct(F.lit(i).alias("cell"), F.array_distinct(representation_tokens(*name.split("/"))).alias("toks"))
                      for i, name in enumerate(names)])
    fold = F.when(md5_bucket("id") < 8000, (md5_bucket("id", seed=42) % n_folds).cast("int")).otherwise(F.lit(-1))
    # read by the counts and by the scores: the answers are stored, not the words of their three representations
    base = stored(views.survey(spark, sf_dir).select("id", "label", fold.alias("fold"), *QUESTIONS), "answers")
    classes = class_list(base)
    rows = base.select("id", index_of("label", classes).alias("y"), "fold", cells.alias("cells"))
    # read by the choice and by the test scores: cells x folds x candidates rows
    found = nb.search_cells(rows, len(classes), n_folds, candidates, cells=len(names)).withColumn(
        "cell", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("cell") + 1)).checkpoint()
    cv_acc = found.where("fold >= 0").groupBy("cell", "cand").agg(F.avg(F.col("hits") / F.col("n")).alias("cv"))
    test = found.where("fold < 0").select("cell", "cand", (F.col("hits") / F.col("n")).alias("test"))
    # cells x candidates rows: a small table; first best candidate wins
    w = Window.partitionBy("cell").orderBy(F.desc("cv"), "cand")
    best = cv_acc.withColumn("rk", F.row_number().over(w)).where("rk = 1").join(test, ["cell", "cand"])
    cand_a = F.array(*[F.lit(a) for a, _ in candidates])
    cand_b = F.array(*[F.lit(b) for _, b in candidates])
    return best.select(
        F.lit("bernoulli_nb").alias("model_name"),
        F.concat(F.lit("a="), F.element_at(cand_a, F.col("cand") + 1).cast("string"),
                 F.lit(",b="), F.element_at(cand_b, F.col("cand") + 1).cast("string")).alias("best_params"),
        round6("cv").alias("best_cv_score"), round6("test").alias("test_score"),
        F.split("cell", "/").getItem(0).alias("feature"), F.split("cell", "/").getItem(1).alias("feature_type"))


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    """One result row per question x representation (24 rows)."""
    return leaderboard(spark, sf_dir)


ROLE_QUESTIONS = ["complexity", "ingredients", "price"]


def _roles(candidate: dict[str, list[str]]) -> list[str]:
    return ["both" if q in candidate["num"] and q in candidate["text"] else "num" if q in candidate["num"] else "text"
            for q in ROLE_QUESTIONS]


def _tokens_sql(question: str, rep: str) -> str:
    if rep == "numerical":
        n = n1_sql(question)
        return f"(CASE WHEN {n} IS NULL THEN []::VARCHAR[] ELSE ['n=' || CAST(CAST(floor({n}) AS BIGINT) AS VARCHAR)] END)"
    return words_sql(question)


def _role_sql() -> str:
    cells = [(q, r) for q in ROLE_QUESTIONS for r in ("numerical", "text")]
    cands = role_candidates(ROLE_QUESTIONS)
    ctes = [(name, sql) for name, sql in grouped_sql(ROLE_QUESTIONS, a=1.0, b=1.0)]
    stack = " UNION ALL ".join(f"SELECT id, y, bucket, '{q}/{r}' AS question, unnest({_tokens_sql(q, r)}) AS token FROM sy" for q, r in cells)
    new = {"st": "SELECT 1 AS unused", "pres": f"SELECT DISTINCT * FROM ({stack})",
           "qs": "SELECT * FROM (VALUES " + ", ".join(f"('{q}/{r}', {i})" for i, (q, r) in enumerate(cells)) + ") t(question, qi)"}
    chosen = ", ".join(f"({i}, '{q}/{r}')" for i, c in enumerate(cands)
                       for r, kind in (("numerical", "num"), ("text", "text")) for q in c[kind])
    roles = ", ".join(f"({i}, " + ", ".join(f"'{x}'" for x in _roles(c)) + ")" for i, c in enumerate(cands))
    names = ", ".join(f"{q}_role" for q in ROLE_QUESTIONS)
    return with_views(f"""
SELECT h.cand, count(*) AS n_test, round(avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy, {names} FROM (
  SELECT id, truth, cand, y AS pred, row_number() OVER (PARTITION BY id, cand ORDER BY s DESC, y) AS rn FROM (
    SELECT qp.id, qp.truth, ch.cand, qp.y, ln(prior.pi) + sum(qp.part) AS s
    FROM qpart qp JOIN prior ON qp.y = prior.y JOIN chosen ch ON ch.question = qp.question
    WHERE qp.bucket >= 8000 GROUP BY qp.id, qp.truth, ch.cand, qp.y, prior.pi)) h
JOIN roles r ON r.cand = h.cand WHERE rn = 1 GROUP BY h.cand, {names}""", "survey",
        extra=[(n, new.get(n, sql)) for n, sql in ctes] + [
            ("chosen", f"SELECT * FROM (VALUES {chosen}) t(cand, question)"),
            ("roles", f"SELECT * FROM (VALUES {roles}) t(cand, {names})")])


@register("role_assignment_search", _role_sql())
def q_role_assignment_search(spark, sf_dir):
    """Every assignment of a role (num / text / both) to each
    number-like question; a candidate's NB score is the prior plus the parts
    of its chosen cells (``q/numerical`` for num, ``q/text`` for text, both
    for both).  Parts are computed once per row and cell; candidates are a
    bounded fan-out of each row, then one aggregate by candidate."""
    s = views.survey(spark, sf_dir)
    classes = class_list(s)
    k = len(classes)
    cell_names = [f"{q}/{r}" for q in ROLE_QUESTIONS for r in ("numerical", "text")]
    cidx = {c: i for i, c in enumerate(cell_names)}
    base = s.select("id", *ROLE_QUESTIONS, index_of("label", classes).alias("y"), md5_bucket("id").alias("bucket"))
    cells = F.array(*[F.struct(F.lit(c).alias("cell"), F.array_distinct(representation_tokens(*c.split("/"))).alias("t"))
                      for c in cell_names])
    long = base.select("id", "y", "bucket", F.explode(cells).alias("c")).select(
        "id", "y", "bucket", "c.cell", F.explode_outer("c.t").alias("token"))
    train = F.col("bucket") < 8000
    labeled = base.where(train).select("id", "y")
    model = nb.fit_grouped(long.where(train), labeled, classes, "cell", a=1.0, b=1.0)
    parts = nb.score_parts(long.where(~train), model, "cell", keep=["y"])
    cmap = F.create_map(*[x for c, i in cidx.items() for x in (F.lit(c), F.lit(i))])
    per_id = parts.groupBy("id", "y").agg(F.map_from_entries(F.collect_list(
        F.struct(F.element_at(cmap, F.col("cell")), F.col("part")))).alias("pm"))
    cands = role_candidates(ROLE_QUESTIONS)
    cand_struct = F.array(*[F.struct(F.lit(i).alias("cand"),
                                     F.array(*[F.lit(cidx[f"{q}/numerical"]) for q in c["num"]],
                                             *[F.lit(cidx[f"{q}/text"]) for q in c["text"]]).cast("array<int>")
                                     .alias("cells")) for i, c in enumerate(cands)])
    logpi = F.array(*[F.lit(math.log(p)) for p in model.prior])
    zero = F.array(*[F.lit(0.0)] * k)
    ex = per_id.select("y", "pm", F.explode(cand_struct).alias("c"))
    score = F.aggregate(F.col("c.cells"), logpi,
                        lambda acc, ci: F.zip_with(acc, F.coalesce(F.element_at(F.col("pm"), ci), zero),
                                                   lambda u, v: u + v))
    hit = (nb.argmax(score) == F.col("y")).cast("double")
    acc = ex.select(F.col("c.cand").alias("cand"), hit.alias("hit")).groupBy("cand").agg(
        F.count(F.lit(1)).alias("n_test"), round6(F.avg("hit")).alias("accuracy"))
    roles = spark.createDataFrame(
        [(i, *_roles(c)) for i, c in enumerate(cands)],
        "cand int, " + ", ".join(f"{q}_role string" for q in ROLE_QUESTIONS))
    return acc.join(roles, "cand")
