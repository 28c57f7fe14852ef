"""The softmax column and the left join with parameters."""

import math

from pyspark.sql import functions as F

from tallyframe.operators import nb
from tallyframe.operators.joins import join_parameters


def test_scores_are_named_once(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "zz1 double, zz2 double")
    project = df.select(nb.softmax(F.array("zz1", "zz2")).alias("p"))._jdf.queryExecution().analyzed().toString().split("\n")[0]
    assert project.count("zz1") == 1


def test_softmax_values(spark):
    rows = [[-700.0, -701.0, -703.5], [0.0, 0.0], [1000.0], None]
    df = spark.createDataFrame([(x,) for x in rows], "s array<double>")
    for r in df.select("s", nb.softmax("s").alias("p")).collect():
        if r["s"] is None:
            assert r["p"] is None
            continue
        e = [math.exp(x - max(r["s"])) for x in r["s"]]
        assert all(abs(a - b / sum(e)) < 1e-12 for a, b in zip(r["p"], e, strict=True))


def test_left_join_keeps_unknown_rows_for_both_sizes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, token string")
    table = spark.createDataFrame([("a", 1.5)], "token string, lo double")
    for count in (1, 10 ** 9):
        assert sorted(map(tuple, join_parameters(rows, table, ["token"], count, "left").select("id", "lo").collect())) == [(1, 1.5), (2, None), (3, None)]
