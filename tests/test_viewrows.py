"""Rows stored once for all training sets: rare words by a shuffle, nothing stored for each view."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import hybrid, softmax_batch as sb, viewrows

from test_foldwise import survey

FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    out = [(i, p, s, m, y, i * 7 % FOLDS if i % 9 else -1) for i, p, _, s, m, _, y, _ in survey(120)]
    return spark.createDataFrame(out, "id bigint, price string, setting string, movie string, y int, fold int").persist()


def build(rows, views):
    return hybrid.build(rows, 3, FOLDS, views, ["price"], ["setting"], ["movie"], ["movie"], [(1.0, 3.0), (0.5, 0.5)], [0.1, 1.0])


def listed(data):
    return {(r["view"], r["id"]): (r["y"], r["fold"], dict(zip(r["columns"], r["vals"]))) for r in data.entries.collect()}


def test_rare_words_and_columns_meet_their_rows_by_a_shuffle(rows, monkeypatch):
    views = hybrid.nested_views([frozenset()], FOLDS)
    want = listed(build(rows, views))
    monkeypatch.setattr(viewrows, "WORDS", 4)
    monkeypatch.setattr(viewrows, "BITS", 3)  # views beyond one number's bits
    got = listed(build(rows, views))
    assert got.keys() == want.keys() and len(got) == 120 + 3 * rows.where("fold >= 0").count()
    for key, (y, fold, values) in want.items():
        assert got[key][:2] == (y, fold) and got[key][2] == pytest.approx(values, abs=1e-7)


def test_rows_are_stored_once_whatever_the_views(rows):
    few, many = (build(rows, v) for v in ([frozenset()], hybrid.nested_views([frozenset()], FOLDS)))
    size = lambda d: sum(len(r["y"]) // 4 for r in d.blocks.frame.select("y").collect())
    assert size(few) == size(many) == 120
    codes = {r["fold"] for r in many.some_entries(many.outer(0)).select("fold").collect()}
    assert codes == {sb.NO_FOLD}


def test_a_block_holds_its_rows_whatever_the_session_sends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sb, "BLOCK_ROWS", 10)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        some = spark.range(0, 1000, 1, 1).select(F.lit(0).alias("y"), F.lit(0).alias("fold"), F.array("id").alias("columns"), F.array(F.lit(1.0)).alias("vals"))
        sizes = [len(r["y"]) // 4 for r in sb.row_blocks(some, str(tmp_path / "b")).select("y").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sizes == [10] * 100


def test_columns_that_go_together_take_few_passes(spark, tmp_path):
    """Steps follow the columns' covariance: no more passes for columns that nearly repeat each other."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=400)
    out = [(i, int(rng.integers(3)), 0, list(range(6)), [float(base[i] + 0.01 * rng.normal()) for _ in range(6)]) for i in range(400)]
    few = spark.createDataFrame(out, "id bigint, y int, fold int, columns array<bigint>, vals array<double>")
    fits = sb.fit(sb.row_blocks(few, str(tmp_path / "c")), 6, 3, [sb.Problem(100.0)], tolerance=1e-7)
    assert fits.passes <= 15 and fits.gradient[0] <= 1e-7
