"""Searches over naive Bayes candidates neither store nor send a score of a row, nor the words of each representation."""

from tallyframe.operators import nb
from tallyframe.plans import leaderboard_plans, nb_search_plans

SF = "/root/testdata/sf0.001"


def test_scores_of_candidates_stay_in_their_task(spark):
    plan = nb_search_plans.q_nb_cv_search(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id#" not in plan and "lo0_0" not in plan


def test_the_leaderboard_stores_answers_not_words(spark, monkeypatch):
    kept, whole = [], nb.search_cells
    monkeypatch.setattr(leaderboard_plans, "stored", lambda df, name, f=leaderboard_plans.stored: kept.append(df.columns) or f(df, name))
    monkeypatch.setattr(nb, "search_cells", lambda *a, **b: whole(*a, **b))
    assert leaderboard_plans.leaderboard(spark, SF).count() == 24
    assert kept and all("cells" not in columns for columns in kept)
