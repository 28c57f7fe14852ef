"""All cells, folds and held-out rows in one pass, against one search after another."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import nb
from tallyframe.plans.leaderboard_plans import leaderboard

SCHEMA = "id bigint, y int, fold int, cells array<struct<cell:int,toks:array<string>>>"
CANDS, FOLDS = [(1.0, 3.0), (0.2, 0.5)], 3


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Frequent words that tell the class, a word of its own, words only of held-out rows, cells without words (empty or null)."""
    rng, out = random.Random(7), []
    for i in range(300):
        y, fold = i % 3, rng.choice([-1, 0, 1, 2])
        few = [w for w in "abcdef" if rng.random() < 0.4] + ([f"y{y}"] if i % 4 else [])
        out.append((i, y, fold, [(0, few), (1, [f"only{i // 2}"] + (["test"] if fold < 0 else [])), (2, [] if i % 2 else None), (3, ["x"] if i % 5 == 0 else [])]))
    path = str(tmp_path_factory.mktemp("cells") / "rows")
    spark.createDataFrame(out, SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_cells_equal_separate_searches(spark, rows, monkeypatch, frequent):
    monkeypatch.setattr(nb, "FREQUENT", frequent)
    found = nb.search_cells(rows, 3, FOLDS, CANDS)
    got = {(r["cell"], r["cand"], r["fold"]): (r["n"], r["hits"]) for r in found.collect()}
    long = rows.select("id", "y", "fold", F.explode("cells").alias("c")).select("id", "y", "fold", "c.cell", F.explode_outer("c.toks").alias("token"))
    cv = nb.search(long.where("fold >= 0"), 3, FOLDS, CANDS, group="cell").collect()
    test = nb.search(long.withColumn("fold", F.when(F.col("fold") < 0, 0).otherwise(1)), 3, 2, CANDS, group="cell").where("fold = 0").collect()
    want = {(r["cell"], r["cand"], r["fold"]): (r["n"], r["hits"]) for r in cv} | {(r["cell"], r["cand"], -1): (r["n"], r["hits"]) for r in test}
    assert got == want and len(got) == 4 * 2 * 4


def test_sums_of_a_cell_are_not_shuffled(spark, monkeypatch):
    """Rows go to other tasks as rows, never as the scores of each cell and candidate."""
    plans, whole = [], nb.search_cells if hasattr(nb, "search_cells") else nb.search

    def kept(*args, **more):
        out = whole(*args, **more)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(nb, whole.__name__, kept)
    assert leaderboard(spark, "/root/testdata/sf0.001").count() == 24
    assert plans
    for exchange in [line for plan in plans for line in plan.splitlines() if "Exchange hashpartitioning(id#" in line]:
        assert "cell#" not in exchange
