"""Sources and sinks: CSV round trips, parameter tables, model save/load."""

import os
import tempfile

from pyspark.sql import functions as F

from tallyframe.operators.features import FeatureGenerator, FeatureModel
from tallyframe.sources import csv_io, params, views

from conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="tf-test-", dir="/tmp")


def test_survey_csv_round_trip(spark):
    s = views.survey(spark, SF_SMALL)
    path = os.path.join(_tmp(), "survey")
    csv_io.write_csv(s, path)
    back = csv_io.read_survey_csv(spark, path, s.columns).withColumn("id", F.col("id").cast("bigint"))
    assert back.exceptAll(s).count() == 0 and s.exceptAll(back).count() == 0


def test_na_words_become_null(spark):
    path = os.path.join(_tmp(), "na.csv")
    with open(path, "w") as f:
        f.write('id,movie,drink\n1,None,""\n2,"multi\nline",N/A\n3,Up,tea\n')
    df = csv_io.read_survey_csv(spark, path, ["id", "movie", "drink"]).orderBy("id").collect()
    assert df[0]["movie"] is None and df[0]["drink"] is None
    assert df[1]["movie"] == "multi\nline" and df[1]["drink"] is None
    raw = csv_io.read_strings_csv(spark, path, ["id", "movie", "drink"]).orderBy("id").collect()
    assert raw[0]["movie"] == "None" and raw[0]["drink"] == ""


def test_feature_model_save_load_scores_equal(spark):
    s = views.survey(spark, SF_SMALL)
    m = FeatureGenerator(["complexity", "price"], ["setting"], ["movie"], "tfidf").fit(s)
    path = _tmp()
    m.save(path)
    m2 = FeatureModel.load(spark, path)
    a, b = m.transform(s), m2.transform(s)
    assert m2.offsets == m.offsets and m2.width == m.width
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_theta_sink_partitions(spark):
    df = spark.createDataFrame([("Q3", "w", "Pizza", 0.123456789)], "question string, token string, label string, theta double")
    path = os.path.join(_tmp(), "theta")
    params.write_theta(df, path)
    r = params.read_table(spark, path, "Q3").first()
    assert r["theta"] == 0.1234568


def test_pipeline_save_load_predicts_like_mllib(spark):
    from tallyframe.operators.pipeline import ScoringPipeline, from_mllib
    from tallyframe.plans.model_plans import pipeline_fit, survey_data
    d = survey_data(spark, SF_SMALL)
    k, comps, m, pv, _ = pipeline_fit(d)
    pipe = from_mllib(d.model, comps, k, m, d.classes)
    path = _tmp()
    pipe.save(path)
    loaded = ScoringPipeline.load(spark, path)
    s = views.survey(spark, SF_SMALL)
    mine = loaded.predict(s).select("id", "pred")
    lib = m.transform(pv).select("id", F.col("prediction").cast("int").alias("pred"))
    assert mine.count() == lib.count()
    assert mine.exceptAll(lib).count() == 0
    # rows without any known feature are scored too
    odd = spark.createDataFrame([(-1, "zzz qqq", None, None, "zzz"), (-2, None, "nowhere", None, None), (-3, "", "", "", "")],
                                "id bigint, movie string, setting string, reminder string, drink string")
    odd = odd.select("id", *[(F.col(c) if c in odd.columns else F.lit(None).cast("string")).alias(c) for c in views.QUESTIONS])
    loaded.features.num_cols = []
    got = loaded.predict(odd).collect()
    assert sorted(r["id"] for r in got) == [-3, -2, -1] and {r["pred"] for r in got} == {max(range(len(loaded.bias)), key=lambda i: (loaded.bias[i], -i))}


def test_running_best_log_sink(spark):
    scores = spark.createDataFrame([(1, 0.2), (2, 0.5), (3, 0.5), (4, 0.4), (5, 0.9)], "iteration int, score double")
    path = os.path.join(_tmp(), "log")
    best = csv_io.running_best_log(scores, "iteration", "score", path)
    assert sorted(r["iteration"] for r in best.collect()) == [1, 2, 5]
    back = spark.read.option("header", True).csv(path)
    assert sorted(int(r["iteration"]) for r in back.collect()) == [1, 2, 5]


def test_vocabulary_table_sorted_index(spark):
    v = params.vocabulary_table(spark, {"Q5": ["up", "cars", "Alien"]}).orderBy("idx").collect()
    assert [(r["token"], r["idx"]) for r in v] == [("Alien", 0), ("cars", 1), ("up", 2)]
