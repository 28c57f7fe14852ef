"""Cleaning and category queries on the `survey` and `numbers` views
(S1, P4, P5, P7-P10, N1-N7, A4, A13, C1-C6, C8, T5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import (
    NA_WORDS, PRIORITY_ORDER, md5_bucket, num_first, num_mean, num_or_listcount,
    num_range, num_strict, ordinal_map, round6,
)
from tallyframe.operators import categories as cat
from tallyframe.operators import clean, profile
from tallyframe.operators.labels import class_list, label_encode, label_index_table, one_hot_label
from tallyframe.plans.oracle_views import (
    strip_sql,
    bucket_sql, n1_sql, n2_sql, n3_sql, n4_sql, n5_sql, options_sql, with_views,
)
from tallyframe.plans.registry import register
from tallyframe.sources import views
from tallyframe.sources.views import CATEGORY_QUESTIONS, QUESTIONS

SURVEY_COLS = ["id", *QUESTIONS, "label"]
NUM_Q = ["complexity", "ingredients", "price"]


def _na_sql(c: str) -> str:
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in NA_WORDS)
    return f"CASE WHEN {c} IN ({words}) THEN NULL ELSE {c} END AS {c}"


@register("scan_survey", with_views("SELECT id, " + ", ".join(_na_sql(c) for c in [*QUESTIONS, "label"])
                                    + " FROM survey", "survey"))
def q_scan_survey(spark, sf_dir):
    """The survey table with NA words normalised to NULL."""
    return clean.normalise_na(views.survey(spark, sf_dir), [*QUESTIONS, "label"])


@register("num_mean", with_views(f"SELECT src, id, round({n1_sql('answer')}, 6) AS value FROM numbers", "numbers"))
def q_num_mean(spark, sf_dir):
    """N1 on the `numbers` view."""
    n = views.numbers(spark, sf_dir)
    return n.select("src", "id", round6(num_mean("answer")).alias("value"))


@register("num_or_listcount", with_views(
    f"SELECT id, round({n2_sql('ingredients')}, 6) AS ingredients_n FROM survey", "survey"))
def q_num_or_listcount(spark, sf_dir):
    s = views.survey(spark, sf_dir)
    return s.select("id", round6(num_or_listcount("ingredients")).alias("ingredients_n"))


@register("num_range", with_views(
    f"SELECT id, round({n3_sql('ingredients')}, 6) AS ingredients_n, round({n3_sql('price')}, 6) AS price_n "
    "FROM survey", "survey"))
def q_num_range(spark, sf_dir):
    s = views.survey(spark, sf_dir)
    return s.select("id", round6(num_range("ingredients")).alias("ingredients_n"),
                    round6(num_range("price")).alias("price_n"))


@register("num_first", with_views(
    f"SELECT id, {n4_sql('ingredients')} AS ingredients_n, {n4_sql('price')} AS price_n FROM survey", "survey"))
def q_num_first(spark, sf_dir):
    s = views.survey(spark, sf_dir)
    return s.select("id", num_first("ingredients").alias("ingredients_n"), num_first("price").alias("price_n"))


@register("num_strict", with_views(
    f"SELECT id, {n5_sql('complexity')} AS complexity_n, {n5_sql('price')} AS price_n FROM survey", "survey"))
def q_num_strict(spark, sf_dir):
    s = views.survey(spark, sf_dir)
    return s.select("id", num_strict("complexity").alias("complexity_n"), num_strict("price").alias("price_n"))


_IMPUTE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS question, round(coalesce(avg({n1_sql(c)}), 1.0), 6) AS impute_value FROM survey" for c in NUM_Q)


@register("impute_mean", with_views(_IMPUTE_SQL, "survey"))
def q_impute_mean(spark, sf_dir):
    """Stored mean by question (default 1 when all missing)."""
    p = clean.impute_fit(views.survey(spark, sf_dir), NUM_Q, default=1.0)
    return p.select("question", round6("impute_value").alias("impute_value"))


_IMPUTE_TRAIN = " UNION ALL ".join(
    f"SELECT '{c}' AS question, coalesce(avg({n1_sql(c)}), 1.0) AS v FROM survey "
    f"WHERE {bucket_sql('id')} < 8000" for c in NUM_Q)
_IMPUTE_APPLY = with_views(
    "SELECT id, " + ", ".join(
        f"round(coalesce({n1_sql(c)}, (SELECT v FROM params WHERE question = '{c}')), 6) AS {c}" for c in NUM_Q)
    + f" FROM survey WHERE {bucket_sql('id')} >= 8000", "survey", extra=[("params", _IMPUTE_TRAIN)])


@register("impute_apply", _IMPUTE_APPLY)
def q_impute_apply(spark, sf_dir):
    """Means fitted on the training split fill the held-out rows."""
    s = views.survey(spark, sf_dir).withColumn("bucket", md5_bucket("id"))
    params = clean.impute_fit(s.where(F.col("bucket") < 8000), NUM_Q, default=1.0)
    out = clean.impute_apply(s.where(F.col("bucket") >= 8000), params, NUM_Q)
    return out.select("id", *[round6(c).alias(c) for c in NUM_Q])


_PQ_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS question, CAST(count(*) FILTER (WHERE {n1_sql(c)} IS NULL) AS BIGINT) AS n_missing, "
    f"count(*) AS n_rows FROM survey" for c in NUM_Q)


@register("parse_quality", with_views(_PQ_SQL, "survey"))
def q_parse_quality(spark, sf_dir):
    """A4: missing after number extraction, by question."""
    return clean.missing_counts(views.survey(spark, sf_dir), NUM_Q)


@register("fill_zero", with_views(
    "SELECT id, " + ", ".join(f"coalesce({c}, '0') AS {c}" for c in [*QUESTIONS, "label"]) + " FROM survey",
    "survey"))
def q_fill_zero(spark, sf_dir):
    """Every missing answer -> '0'."""
    s = views.survey(spark, sf_dir)
    return clean.fill_constant(s, "0", [*QUESTIONS, "label"])


@register("filter_low_price", with_views(
    f"SELECT id, round({n1_sql('price')}, 6) AS price_n, label FROM survey WHERE {n1_sql('price')} <= 3", "survey"))
def q_filter_low_price(spark, sf_dir):
    """P5: rows whose parsed price is at most 3."""
    s = views.survey(spark, sf_dir).withColumn("price_n", num_mean("price"))
    return s.where(F.col("price_n") <= 3).select("id", round6("price_n").alias("price_n"), "label")


@register("preview", with_views(
    "SELECT id, complexity, ingredients, setting, price, label FROM survey ORDER BY id LIMIT 10", "survey"))
def q_preview(spark, sf_dir):
    """First rows by id (the limit is the feature; Spark plans TakeOrdered)."""
    s = views.survey(spark, sf_dir)
    return s.select("id", "complexity", "ingredients", "setting", "price", "label").orderBy("id").limit(10)


@register("profile_nonnull", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) AS n_rows FROM survey" for c in SURVEY_COLS),
    "survey"))
def q_profile_nonnull(spark, sf_dir):
    """P10: non-null count of every column."""
    return profile.non_null_profile(views.survey(spark, sf_dir), SURVEY_COLS).drop("dtype")


_ORD_CASE = "CASE hotsauce " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY_ORDER.items()) + " ELSE 0 END"


@register("ordinal_map", with_views(f"SELECT id, CAST({_ORD_CASE} AS INTEGER) AS hotsauce_ord FROM survey", "survey"))
def q_ordinal_map(spark, sf_dir):
    """Ordinal answer -> integer; unseen and NULL -> 0."""
    s = views.survey(spark, sf_dir)
    return s.select("id", ordinal_map("hotsauce", PRIORITY_ORDER).alias("hotsauce_ord"))


@register("onehot_label", with_views(
    "SELECT id, " + ", ".join(f"CAST(coalesce({strip_sql('label')}, '') = '{v}' AS INTEGER) AS \"Label_{v}\"" for v in "FOP")
    + " FROM survey", "survey"))
def q_onehot_label(spark, sf_dir):
    """C5 + P4: one 0/1 column per class, then the ``Label_`` columns by prefix."""
    s = views.survey(spark, sf_dir)
    oh = one_hot_label(s.select("id", "label"), class_list(s))
    return oh.select("id", *[c for c in oh.columns if c.startswith("Label_")])


ENCODED = ["ingredients", "setting", "price", "drink"]


@register("label_encode", with_views(
    "SELECT id, " + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, '0')) - 1 AS BIGINT) AS {c}" for c in ENCODED)
    + " FROM survey", "survey"))
def q_label_encode(spark, sf_dir):
    """C4: fill '0', then the index of each value in the column's sorted values."""
    s = views.survey(spark, sf_dir).select("id", *ENCODED)
    return label_encode(s, ENCODED).select("id", *ENCODED)


@register("label_index", with_views(
    "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx FROM "
    "(SELECT DISTINCT coalesce(regexp_replace(label, '^\\s+|\\s+$', '', 'g'), '') AS label FROM survey)", "survey"))
def q_label_index(spark, sf_dir):
    """Sorted label dimension with 0-based index."""
    return label_index_table(views.survey(spark, sf_dir))


ROLES = {"num": ["complexity", "ingredients", "price"], "cate": ["setting", "reminder"],
         "text": ["movie", "drink"]}
_ROLE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS question, '{next((r for r, cs in ROLES.items() if c in cs), 'none')}' AS role, "
    f"count({c}) AS n_answered FROM survey" for c in QUESTIONS)


@register("role_map", with_views(_ROLE_SQL, "survey"))
def q_role_map(spark, sf_dir):
    """{role: [columns]} inverted to (question, role), with answered counts."""
    s = views.survey(spark, sf_dir)
    roles = cat.role_table(ROLES, QUESTIONS, spark)
    answered = profile.non_null_profile(s, QUESTIONS).select(F.col("column").alias("question"),
                                                               F.col("non_null").alias("n_answered"))
    # both sides have one row per question
    return roles.join(answered, "question")


_OPT_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT id, '{c}' AS question, unnest({options_sql(c)}) AS option FROM survey" for c in CATEGORY_QUESTIONS)


@register("categories", with_views("SELECT DISTINCT question, option FROM opts", "survey", extra=[("opts", _OPT_SQL)]))
def q_categories(spark, sf_dir):
    """Option domain of each multi-select question."""
    return cat.domain(views.survey(spark, sf_dir), CATEGORY_QUESTIONS)


_MH_SQL = with_views(
    f"""SELECT o.id, o.question, o.option, 1 AS value FROM opts o
        WHERE (o.question, o.option) IN (SELECT question, option FROM opts JOIN survey s USING (id)
                                         WHERE {bucket_sql('s.id')} < 8000)""",
    "survey", extra=[("opts", _OPT_SQL)])


@register("multihot", _MH_SQL)
def q_multihot(spark, sf_dir):
    """Domain fitted on the training split, applied to every row."""
    s = views.survey(spark, sf_dir)
    dom = cat.domain(s.where(md5_bucket("id") < 8000), CATEGORY_QUESTIONS)
    return cat.multi_hot(s, dom, CATEGORY_QUESTIONS).select("id", "question", "option", "value")


@register("vocab_phrases", with_views(
    f"SELECT DISTINCT unnest({options_sql('ingredients')}) AS phrase FROM survey", "survey"))
def q_vocab_phrases(spark, sf_dir):
    """T5: comma-separated phrases, stripped, distinct."""
    s = views.survey(spark, sf_dir)
    return cat.option_long(s, ["ingredients"]).select(F.col("option").alias("phrase")).distinct()


@register("filter_low_ingredients", with_views(
    f"SELECT id, round({n1_sql('ingredients')}, 6) AS ingredients_n, label FROM survey "
    f"WHERE {n1_sql('ingredients')} <= 3", "survey"))
def q_filter_low_ingredients(spark, sf_dir):
    """P5 on a column where the comparison selects rows at every scale."""
    s = views.survey(spark, sf_dir).withColumn("ingredients_n", num_mean("ingredients"))
    return s.where(F.col("ingredients_n") <= 3).select("id", round6("ingredients_n").alias("ingredients_n"), "label")
