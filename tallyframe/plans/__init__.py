"""Registered queries (Spark) and their DuckDB oracle SQL."""

from tallyframe.plans.registry import QUERIES, ORACLE, register
from tallyframe.plans import nb_plans, clean_plans, profile_plans, split_plans, text_plans, nb_search_plans, misc_plans, model_plans, search_plans, knn_plans, leaderboard_plans  # noqa: F401

__all__ = ["QUERIES", "ORACLE", "register"]
