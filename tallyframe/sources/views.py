"""Views that map the driver's tables onto the survey data model.

Each view is a lazy DataFrame; see FIXTURES.md section 2 for the derivation.
The identical DuckDB text of every view is in ``tallyframe.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.tables import bound_scans, table

# Short question names of the survey, in question order, and the
# reverse map of the long question text (alias map of the reference).
QUESTIONS = ["complexity", "ingredients", "setting", "price", "movie",
             "drink", "reminder", "hotsauce"]
NUMERIC_QUESTIONS = ["complexity", "ingredients", "price"]
CATEGORY_QUESTIONS = ["setting", "reminder"]
TEXT_QUESTIONS = ["movie", "drink"]
ORDINAL_QUESTIONS = ["hotsauce"]


def _distinct_list(c, sep: str):
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def _dec2(c):
    return c.cast("decimal(12,2)").cast("string")


#: Orders of a partition of the survey: a task sums the words of that many, whatever the size of the tables.
ORDERS = 20_000
#: Bytes of a file that a task reads which deals the lines by order.
SCAN_BYTES = 16 << 20


def survey_partitions(spark: SparkSession, orders: int) -> int:
    """Partitions of the survey, which grow with its rows."""
    return max(spark.sparkContext.defaultParallelism, orders // ORDERS + 1)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; answers are strings, label = order status.

    The lines lie by order before they are collected, so nothing is sent
    twice and the result is hash-partitioned by id.
    """
    bound_scans(spark, SCAN_BYTES)
    t = lambda n: table(spark, sf_dir, n)
    o = t("orders")
    parts = survey_partitions(spark, o.count())
    li = (t("lineitem")
          .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
          .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
          .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
          .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
          .select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "p_type", "p_name", "p_brand", "r_name")
          .repartition(parts, "l_orderkey")
          .groupBy(F.col("l_orderkey").alias("k"))
          .agg(F.count(F.lit(1)).alias("nlines"),
               F.min("l_quantity").alias("min_qty"),
               F.max("l_quantity").alias("max_qty"),
               _distinct_list(F.col("p_type"), ", ").alias("types"),
               _distinct_list(F.concat(F.col("l_returnflag"), F.lit(" "), F.col("l_linestatus")), ", ").alias("settings"),
               _distinct_list(F.col("p_name"), " ").alias("names"),
               F.min(F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand"))).alias("drink"),
               _distinct_list(F.col("r_name"), ", ").alias("regions")))
    j = o.repartition(parts, "o_orderkey").join(li, F.col("o_orderkey") == F.col("k"), "left")
    idc = F.col("o_orderkey")
    n = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    ingredients = (F.when(idc % 17 == 0, F.lit(None).cast("string"))
                   .when(idc % 3 == 0, F.concat(F.lit("between "), F.col("min_qty").cast("bigint").cast("string"),
                                                F.lit(" and "), F.col("max_qty").cast("bigint").cast("string")))
                   .when(idc % 3 == 1, F.col("types"))
                   .otherwise(_dec2(F.col("o_totalprice") / 10000)))
    price = (F.when(idc % 11 == 0, F.lit(None).cast("string"))
             .when(idc % 5 == 0, F.concat(n.cast("string"), F.lit("-"), (n + 5).cast("string"), F.lit(" dollars")))
             .otherwise(F.concat(F.lit("$"), _dec2(F.col("o_totalprice")))))
    return j.select(
        idc.alias("id"),
        F.col("nlines").cast("string").alias("complexity"),
        ingredients.alias("ingredients"),
        F.col("settings").alias("setting"),
        price.alias("price"),
        F.when(idc % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("names")).alias("movie"),
        F.col("drink"),
        F.col("regions").alias("reminder"),
        F.when(idc % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("hotsauce"),
        F.col("o_orderstatus").alias("label"),
    )


def docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))


def docs_quality(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col("quality").cast("string").alias("label"))


def chat(spark, sf_dir) -> DataFrame:
    """``id = conv_id * 1000 + turn`` (turns are < 1000)."""
    c = table(spark, sf_dir, "conversations")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text",
                    F.col("role").alias("label"))


def numbers(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), F.col("props").alias("answer"))
    pg = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("src"), F.col("page_id").alias("id"), F.col("url").alias("answer"))
    return ev.unionByName(pg)


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        F.col("label").cast("string").alias("label"))


def measures(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("value").alias("x"), F.col("event_type").alias("label"))


def baskets(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    opts = o.groupBy("o_custkey").agg(_distinct_list(F.col("o_orderpriority"), ", ").alias("options"))
    return (c.join(opts, c.c_custkey == opts.o_custkey, "left")
            .select(F.col("c_custkey").alias("id"), "options", F.col("c_mktsegment").alias("label")))


def scores(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("c"), F.col("event_type").alias("model"),
                    (F.col("user_id") % 8).alias("feature"), (F.col("user_id") % 3).alias("feature_type"),
                    F.col("value").alias("score"))
