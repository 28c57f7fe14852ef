"""Rows never are the broadcast side of a join with parameters, whatever Spark takes their size for."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import linear, softmax_batch as sb
from tallyframe.operators.features import FeatureGenerator
from tallyframe.operators.foldwise import fit_features
from tallyframe.operators.joins import BROADCAST_ROWS, join_parameters, join_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def answers(spark, tmp_path_factory):
    """Many words an answer, in a file far smaller than the words."""
    path = str(tmp_path_factory.mktemp("answers") / "rows")
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("w"), (F.col("id") + i) % 50)))
    spark.range(4000).select("id", words.alias("movie"), F.lit("a, b").alias("setting"), (F.col("id") % 2).cast("int").alias("y"),
                             (F.col("id") % 5).cast("int").alias("fold")).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def test_words_of_rows_are_not_broadcast(spark, answers):
    features = fit_features(answers, [frozenset()], 5, (), ["setting"], ["movie"])
    model = FeatureGenerator((), ["setting"], ["movie"]).fit(answers)
    for found in (features.transform(answers), model.transform(answers)):
        text = plan(found)
        assert text.count("BroadcastHashJoin") >= 2
        assert "BuildLeft" not in text  # the rows are on the left
        assert found.count() == 4000 * 42
        assert found.select("id", "feature").distinct().count() == 4000 * 42


def test_rows_meet_rows_by_a_shuffle(spark, answers):
    per = answers.groupBy("id").agg(F.count("*").alias("n"))
    assert "BroadcastHashJoin" not in plan(join_rows(answers.select("id"), per))
    long = answers.select("id", F.lit(0).alias("feature"), F.lit(1.0).alias("value"))
    for made in (sb.entry_rows(long, answers.select("id", "y", "fold")), linear.to_vectors(long, 1, answers.select("id", "y"))):
        text = plan(made)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_large_parameters_meet_rows_by_a_shuffle(spark, answers):
    rows, table = answers.select("id"), spark.range(4000, 0, -1).select("id", F.lit(1).alias("w"))
    few, many = (join_parameters(rows, table, ["id"], n) for n in (BROADCAST_ROWS, BROADCAST_ROWS + 1))
    assert "BroadcastHashJoin" in plan(few) and "BroadcastHashJoin" not in plan(many)
    assert sorted(r["id"] for r in few.collect()) == sorted(r["id"] for r in many.collect())
