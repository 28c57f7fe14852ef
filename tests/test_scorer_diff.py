"""Both scorers run once, though their rows are compared from both sides."""

from tallyframe.plans import QUERIES


def test_scores_are_made_once(spark):
    found = QUERIES["scorer_diff"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") >= 4
    assert "explode(" not in plan.replace("replicaterows", "")
    assert [r["n_diff"] for r in found.collect()] == [0]
