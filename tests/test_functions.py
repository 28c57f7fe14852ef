"""Edge rows of the column expressions (FIXTURES section 4)."""

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import (
    PRIORITY_ORDER, num_first, num_mean, num_or_listcount, num_range, num_strict, ordinal_map, split_options, tokens,
)
from tallyframe.operators.labels import clean_label


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


def test_num_mean(spark):
    got = _one(spark, ["5-10", "12 to 15.5, 7", "none", None, "3"], num_mean)
    assert got == [7.5, pytest.approx(11.5), None, None, 3.0]


def test_num_or_listcount(spark):
    assert _one(spark, ["rice, fish, nori", "just rice", "a-b"], num_or_listcount) == [3.0, None, 2.0]


def test_num_range(spark):
    got = _one(spark, ["5-10", "about 5 or 10", "5 tomatoes and 7", "3.5", "x", None], num_range)
    assert got == [7.5, 5.0, 6.0, 3.0, 0.0, 0.0]


def test_num_first_and_strict(spark):
    assert _one(spark, ["$12.50", "none"], num_first) == [12.0, None]
    assert _one(spark, ["1,234.5", "5-10"], num_strict) == [1234.5, None]


def test_split_options(spark):
    got = _one(spark, [" Friends ,Parents", "Friends,", None], split_options)
    assert got == [["Friends", "Parents"], ["Friends"], []]


def test_ordinal_map(spark):
    got = _one(spark, ["5-LOW", "2-HIGH", "unknown", None], lambda c: ordinal_map(c, PRIORITY_ORDER))
    assert got == [1, -1, 0, 0]


def test_tokens_unicode(spark):
    assert _one(spark, ["L'été 2024_x!", ""], tokens) == [["l", "été", "2024_x"], []]


def test_clean_label(spark):
    assert _one(spark, [None, "  Pizza\t"], clean_label) == ["", "Pizza"]
