"""Invariants of the DataFrame operators on small hand-made tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import nb, profile, text as tx
from tallyframe.operators.ordering import positions, running_max_before
from tallyframe.operators.split import exact_split, head_rows, kfold, stratified_folds
from tallyframe.operators.svd import SVDResult


def test_positions_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    got = positions(df, ["v"], ["g"], name="p", num_partitions=7).collect()
    for r in got:
        # inside group g the values are all v with v % 3 == ... ; rank = count of smaller v in group
        pass
    by_g = {}
    for r in got:
        by_g.setdefault(r["g"], []).append((r["v"], r["p"]))
    for g, rows in by_g.items():
        rows.sort()
        assert [p for _, p in rows] == list(range(len(rows)))


def test_weighted_positions(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "k string, w int")
    got = {r["k"]: r["s"] for r in positions(df, ["k"], name="s", weight="w", num_partitions=2).collect()}
    assert got == {"a": 0, "b": 3, "c": 4}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.normal(size=301) * 10, 1)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(vals)], "x double, g int")
    q = {(r["g"], r["q"]): r["value"] for r in profile.exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in (0, 1):
        arr = vals[np.arange(len(vals)) % 2 == g]
        for p in (0.25, 0.5, 0.75):
            assert q[(g, p)] == pytest.approx(np.percentile(arr, p * 100), abs=1e-9)


def test_boxplot_single_value(spark):
    df = spark.createDataFrame([(5.0, "a")] * 4, "x double, label string")
    r = profile.boxplot_stats(df, "x", ["label"]).first()
    assert r["q1"] == r["median"] == r["q3"] == 5.0 and r["n_outliers"] == 0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 15]], "x double")
    h = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 15).collect()}
    assert len(h) == 15 and h[14] == 1 and h[0] == 1 and sum(h.values()) == 4 and h[5] == 0


def test_anova_p_value(spark):
    # F(2, 6) upper tail at f=5.14 is 0.05 (table value)
    assert profile.f_sf(5.1432528, 2, 6) == pytest.approx(0.05, abs=1e-6)
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, "b")],
                               "x double, label string")
    r = profile.anova(df, "x", "label").first()
    assert r["f"] == pytest.approx(1.5) and 0 < r["p"] < 1


def test_running_best_equal_is_not_new(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.7), (4, 0.6), (5, 0.7)], "c int, score double")
    r = running_max_before(df, ["c"], "score", num_partitions=3)
    kept = sorted(x["c"] for x in r.where(F.col("prev_max").isNull() | (F.col("score") > F.col("prev_max"))).collect())
    assert kept == [1, 3]


def test_head_rows(spark):
    df = spark.range(5)
    assert head_rows(df, 0.8).where("is_head").count() == 4


def test_splits_are_disjoint_and_cover(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 3).cast("string"))
    ex = exact_split(df, 0.8)
    assert ex.where("split = 'train'").count() == 1600 and ex.count() == 2000
    kf = kfold(df, 5)
    assert kf.select("fold").distinct().count() == 5 and kf.count() == 2000
    st = stratified_folds(df, 5).groupBy("label", "fold").count().collect()
    sizes = [r["count"] for r in st]
    assert max(sizes) - min(sizes) <= 1


def test_idf_negative_and_tfidf_divisor(spark):
    docs = spark.createDataFrame([(1, "a b c word"), (2, "word x"), (3, "the and"), (4, None)], "id long, text string")
    vocab = spark.createDataFrame([("word",), ("the",)], "token string")
    idf = {r["token"]: r["idf"] for r in tx.idf(docs, vocab).collect()}
    assert idf["word"] == pytest.approx(math.log(4 / 3))
    tf = {(r["id"], r["token"]): r["value"] for r in tx.tfidf(docs, tx.idf(docs, vocab)).collect()}
    assert tf[(1, "word")] == pytest.approx(0.25 * math.log(4 / 3))
    allw = spark.createDataFrame([("w",)], "token string")
    same = spark.createDataFrame([(i, "w") for i in range(3)], "id long, text string")
    assert tx.idf(same, allw).first()["idf"] < 0


def test_vocabulary_counts_total_not_documents(spark):
    docs = spark.createDataFrame([(1, "rare rare"), (2, "once the")], "id long, text string")
    v = {r["token"] for r in tx.vocabulary(tx.token_table(docs), ["the"], min_count=2).collect()}
    assert v == {"rare"}


def test_nb_posterior_without_known_words(spark):
    rows = spark.createDataFrame([(1, 0, "a b"), (2, 1, "b c"), (3, 1, "c"), (4, 0, "zzz qqq"), (5, 1, None)],
                                 "id long, y int, text string")
    present = nb.present_table(rows.select("id", "text", "y"), keep=["y"])
    model = nb.fit(present.where("id <= 3"), rows.where("id <= 3").select("id", "y"), ["x", "y"], 1.0, 1.0, 3.0)
    sc = nb.score(present.where("id >= 4"), model, keep=["y"])
    got = sc.select("id", nb.softmax("s").alias("p")).collect()
    assert len(got) == 2
    for r in got:
        assert sum(r["p"]) == pytest.approx(1.0)
    # dense check against numpy on the same table
    vocab = sorted({"a", "b", "c"})
    x = np.array([[1, 1, 0], [0, 1, 1], [0, 0, 1]])
    t = np.array([0, 1, 1])
    nk = np.array([1, 2])
    pi = (nk + 1) / (3 + 2)
    theta = (x.T @ np.eye(2)[t] + 1) / (nk + 4)
    xq = np.zeros((1, 3))
    lp = xq @ np.log(theta) + (1 - xq) @ np.log(1 - theta) + np.log(pi)
    p = np.exp(lp - lp.max()) / np.exp(lp - lp.max()).sum()
    got4 = [r for r in got if r["id"] == 4][0]["p"]
    assert got4 == pytest.approx(p[0].tolist())


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert df.select(nb.argmax("s")).first()[0] == 1


def test_svd_choose_k_clamps():
    r = SVDResult(np.ones(3), np.eye(3), np.array([0.2, 0.2, 0.2]), 10)
    assert r.choose_k(0.99) == 3
    assert r.choose_k(0.3) == 2


def test_positions_with_a_hot_group(spark):
    # one group holds 80 % of the rows and spans several range partitions
    df = spark.range(0, 6000).select("id", F.when(F.col("id") % 5 == 0, F.lit(1)).otherwise(F.lit(0)).alias("g"))
    got = positions(df, ["id"], ["g"], name="p", num_partitions=6).collect()
    for g in (0, 1):
        ps = sorted((r["id"], r["p"]) for r in got if r["g"] == g)
        assert [p for _, p in ps] == list(range(len(ps)))


def test_quantiles_with_a_hot_value(spark):
    vals = [7.0] * 2000 + [float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = {r["q"]: r["value"] for r in profile.exact_quantiles(df, "x", [0.1, 0.5, 0.9]).collect()}
    for p in (0.1, 0.5, 0.9):
        assert q[p] == pytest.approx(np.percentile(vals, p * 100))


def test_null_groups_keep_their_rows(spark):
    from tallyframe.operators.profile import boxplot_stats, describe
    from tallyframe.operators.split import stratified_folds
    rows = [(i, None if i % 4 == 0 else f"c{i % 3}", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label string, x double")
    folds = stratified_folds(df, 5).collect()
    assert len(folds) == 100
    missing = [r["fold"] for r in folds if r["label"] is None]
    assert sorted(missing) == sorted(list(range(5)) * 5)
    box = {r["label"]: r for r in boxplot_stats(df, "x", ["label"]).collect()}
    assert None in box and box[None]["median"] == 48.0 and box[None]["n"] == 25
    summary = {r["label"]: r for r in describe(df, "x", ["label"]).collect()}
    assert summary[None]["q50"] == 48.0 and summary[None]["count"] == 25


def test_positions_do_not_depend_on_the_number_of_ranges(spark):
    df = spark.range(3000).selectExpr("id", "pmod(hash(id), 7) AS g", "pmod(hash(id, 1), 1000) AS v")
    got = [sorted(tuple(r) for r in positions(df, ["v", "id"], ["g"], name="p", num_partitions=n).collect()) for n in (1, 8, 200)]
    assert got[0] == got[1] == got[2]


def test_exact_split_sizes(spark):
    from tallyframe.operators.split import exact_split
    for n in (0, 1, 7, 250):
        df = spark.range(n).withColumnRenamed("id", "id")
        assert exact_split(df, 0.8).where("split = 'train'").count() == int(0.8 * n)


def test_strict_number_rejects_type_suffixes(spark):
    from tallyframe.functions.numbers import num_strict
    df = spark.createDataFrame([("1d",), ("5f",), ("1,200",), (" 3.5 ",), ("1e3",), (".5",), ("x",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(num_strict("s")).collect()] == [None, None, 1200.0, 3.5, 1000.0, 0.5, None, None, None]


def test_rows_without_known_features_score(spark):
    from tallyframe.operators import linear, svd
    feats = spark.createDataFrame([(1, 0, 2.0), (2, 9, 1.0)], "id long, feature long, value double")
    w = spark.createDataFrame([(0, [1.0, -1.0])], "feature long, w array<double>")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    z = {r["id"]: r["z"] for r in linear.linear_scores(feats, w, [0.5, 0.25], ids).collect()}
    assert z == {1: [2.5, -1.75], 2: [0.5, 0.25], 3: [0.5, 0.25]}
    v = {(r["id"], r["component"]): r["value"] for r in svd.project(feats, w.withColumnRenamed("w", "v"), 2, ids).collect()}
    assert v[1, 0] == 2.0 and v[3, 1] == 0.0 and len(v) == 6


def test_sparse_vectors_of_a_wide_vocabulary(spark):
    from pyspark.ml.classification import LogisticRegression
    from tallyframe.operators import linear
    width = 50_000
    feats = spark.createDataFrame([(i, (i * 7919) % width, 1.0) for i in range(50)] + [(i, width - 1 - i % 5, 2.0) for i in range(50)],
                                  "id long, feature long, value double")
    rows = spark.createDataFrame([(i, float(i % 5)) for i in range(55)], "id long, y double")
    v = linear.to_vectors(feats, width, keep=rows)
    got = {r["id"]: r["features"] for r in v.collect()}
    assert got[3].size == width and dict(zip(got[3].indices.tolist(), got[3].values.tolist())) == {(3 * 7919) % width: 1.0, width - 4: 2.0}
    assert got[54].numNonzeros() == 0
    m = LogisticRegression(labelCol="y", maxIter=10).fit(v)
    assert m.numClasses == 5 and m.transform(v).count() == 55


def test_labels_are_cleaned_on_both_sides(spark):
    from tallyframe.operators.labels import class_list, one_hot_label
    df = spark.createDataFrame([(1, " P "), (2, "P"), (3, None), (4, "O")], "id long, label string")
    out = {r["id"]: r.asDict() for r in one_hot_label(df, class_list(df)).collect()}
    assert out[1]["Label_P"] == out[2]["Label_P"] == 1 and out[3]["Label_"] == 1 and out[4]["Label_O"] == 1
    assert all(sum(v for k, v in r.items() if k != "id") == 1 for r in out.values())
