"""Split and fold queries on the `survey` view."""

from __future__ import annotations

from tallyframe.operators import split
from tallyframe.plans.oracle_views import bucket_sql, with_views
from tallyframe.plans.registry import register
from tallyframe.sources import views


@register("split_hash_80_20", with_views(
    f"SELECT id, CASE WHEN {bucket_sql('id')} < 8000 THEN 'train' ELSE 'test' END AS split FROM survey", "survey"))
def q_split_hash(spark, sf_dir):
    """md5-bucket 80/20 split."""
    return split.hash_split(views.survey(spark, sf_dir).select("id"))


@register("split_seeded_80_20", with_views(
    f"SELECT id, CASE WHEN {bucket_sql('id', seed=78)} < 8000 THEN 'train' ELSE 'test' END AS split FROM survey",
    "survey"))
def q_split_seeded(spark, sf_dir):
    """The split with its own salt (the reference's second shuffle seed)."""
    return split.hash_split(views.survey(spark, sf_dir).select("id"), seed=78)


@register("split_exact_80_20", with_views(
    f"""SELECT id, CASE WHEN row_number() OVER (ORDER BY {bucket_sql('id')}, id) - 1 < floor(0.8 * count(*) OVER ())
               THEN 'train' ELSE 'test' END AS split FROM survey""", "survey"))
def q_split_exact(spark, sf_dir):
    """Exactly int(0.8 n) training rows in hash order."""
    return split.exact_split(views.survey(spark, sf_dir).select("id"))


@register("kfold", with_views(f"SELECT id, CAST({bucket_sql('id', seed=42)} % 5 AS INTEGER) AS fold FROM survey",
                              "survey"))
def q_kfold(spark, sf_dir):
    """Shuffled 5-fold column."""
    return split.kfold(views.survey(spark, sf_dir).select("id"), 5)


@register("stratified_folds", with_views(
    f"""SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {bucket_sql('id', seed=42)}, id) - 1) % 5
               AS INTEGER) AS fold FROM survey""", "survey"))
def q_stratified_folds(spark, sf_dir):
    """Class-balanced folds."""
    return split.stratified_folds(views.survey(spark, sf_dir).select("id", "label"), 5)
