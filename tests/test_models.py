"""Rows-only queries: shape and invariants at sf0.001."""

import numpy as np
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

Q = E.queries()


def test_svd_ratios(spark):
    rows = Q["svd_choose_k"](spark, SF_SMALL).orderBy("component").collect()
    cum = [r["cum_ratio"] for r in rows]
    assert all(b >= a - 1e-12 for a, b in zip(cum, cum[1:]))
    assert cum[-1] == pytest.approx(1.0, abs=1e-6)
    k = rows[0]["k"]
    assert cum[k - 1] >= 0.95 and (k == 1 or cum[k - 2] < 0.95)


def test_leaderboard_grid(spark):
    rows = Q["leaderboard"](spark, SF_SMALL).collect()
    assert len(rows) == 24
    assert {(r["feature"], r["feature_type"]) for r in rows}.__len__() == 24
    assert all(0 <= r["test_score"] <= 1 for r in rows)


def test_role_assignment_candidates(spark):
    rows = Q["role_assignment_search"](spark, SF_SMALL).collect()
    assert len(rows) == 27 and len({r["n_test"] for r in rows}) == 1


def test_anova_p_in_range(spark):
    r = Q["anova"](spark, SF_SMALL).first()
    assert r["f"] > 0 and 0 <= r["p"] <= 1


def test_forest_accuracy_row(spark):
    r = Q["forest_fit"](spark, SF_SMALL).first()
    assert r["n_test"] > 0 and 0 <= r["accuracy"] <= 1


@pytest.fixture(scope="module")
def survey(spark):
    from tallyframe.plans.model_plans import survey_data
    return survey_data(spark, SF_SMALL)


def _gradient(rows, w, b, reg):
    """Norm of the gradient of the regularised mean log-loss at (w, b), and at zero."""
    x = np.array([r["features"].toArray() for r in rows])
    y = np.eye(len(b))[[int(r["y"]) for r in rows]]

    def norm(w, b):
        z = x @ w.T + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return np.linalg.norm((p - y).T @ x / len(x) + reg * w)
    return norm(w, b), norm(np.zeros_like(w), np.zeros_like(b))


def test_fitted_softmax_is_near_a_minimum(spark, survey):
    d, c = survey, 1.0
    table = Q["softmax_fit"](spark, SF_SMALL).collect()
    rows = d.vectors.where("bucket < 8000").collect()
    w, b = np.zeros((len(d.classes), d.model.width)), np.zeros(len(d.classes))
    for r in table:
        if r["feature"] < 0:
            b[d.classes.index(r["label"])] = r["w"]
        else:
            w[d.classes.index(r["label"]), r["feature"]] = r["w"]
    here, zero = _gradient(rows, w, b, 1.0 / (c * len(rows)))
    assert here < 1e-3 * zero


def test_stacked_probabilities_sum_to_one(spark):
    p = Q["cat_stacked"](spark, SF_SMALL).groupBy("id", "question").agg({"prob": "sum"})
    assert all(abs(r[2] - 1) < 1e-4 for r in p.collect())


@pytest.mark.parametrize("name", ["ovr_logistic", "pipeline_train"])
def test_accuracies_are_shares(spark, name):
    r = Q[name](spark, SF_SMALL).first()
    assert r["n_test"] > 0 and 0 <= r["accuracy"] <= 1


def test_hybrid_predicts_every_held_out_row(spark, survey):
    pred = Q["hybrid_predict"](spark, SF_SMALL)
    assert pred.count() == survey.rows.where("bucket >= 8000").count()
    assert {r[0] for r in pred.select("pred_label").distinct().collect()} <= set(survey.classes)


def test_search_winners(spark):
    rows = Q["lr_search"](spark, SF_SMALL).collect()
    assert len(rows) == 10 and all(0 <= r["cv_accuracy"] <= 1 for r in rows)
    [best] = [r for r in rows if r["best"]]
    assert best["cv_accuracy"] == max(r["cv_accuracy"] for r in rows)


def test_subset_search_with_loops_switched_off(spark):
    from tallyframe.plans.search_plans import subset_search
    rows = subset_search(spark, SF_SMALL, loop_numeric=False, loop_categorical=False).collect()
    assert [r["text_features"] for r in rows] == ["", "movie", "drink", "movie,drink"]
    assert {(r["numeric_features"], r["categorical_features"]) for r in rows} == {("complexity,ingredients,price", "setting,reminder")}
    [best] = [r for r in rows if r["best"]]
    assert best["accuracy"] == max(r["accuracy"] for r in rows)


def test_refit_uses_every_row(spark, survey):
    rows = Q["refit_all"](spark, SF_SMALL).collect()
    assert {r["label"] for r in rows} == set(survey.classes) and sum(r["feature"] == -1 for r in rows) == 3
    assert abs(sum(r["w"] for r in rows if r["feature"] == -1)) < 1e-9


def test_scorer_diff_is_zero(spark):
    assert Q["scorer_diff"](spark, SF_SMALL).first()["n_diff"] == 0


def test_pipeline_search_takes_prefixes(spark):
    rows = Q["pipeline_search"](spark, SF_SMALL).collect()
    assert len(rows) == 30 and sum(r["best"] for r in rows) == 1
    sizes = {r["share"]: r["components"] for r in rows}
    assert [sizes[s] for s in sorted(sizes)] == sorted(sizes.values())
    same = {}
    for r in rows:
        same.setdefault((r["components"], r["c"]), set()).add((r["cv_accuracy"], r["test_accuracy"]))
    assert all(len(v) == 1 for v in same.values())  # equal prefixes are equal models


def test_sketches_merge_to_the_vocabulary_size(spark):
    from pyspark.sql import functions as F
    from tallyframe.operators import text
    tok = spark.range(30_000).select((F.col("id") % 5).alias("part"), (F.col("id") % 3).alias("day"), (F.col("id") % 7000).cast("string").alias("token"))
    sketches = text.token_sketches(tok, ["part", "day"])
    assert sketches.count() == 15
    for keys, size in ((["part"], 1400), (["day"], 7000)):
        for r in text.merged_sizes(sketches, keys).collect():
            assert abs(r["approx_size"] / size - 1) < 0.03
    assert text.token_sketches(tok.where("false"), ["part"]).count() == 0
    got = Q["vocab_size_sketch"](spark, SF_SMALL).collect()
    assert len(got) == 8 and all(r["error"] <= 0.03 and r["sketches"] > 1 for r in got)
