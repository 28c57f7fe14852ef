"""What a task of the survey queries holds doesn't grow with the tables."""

from pyspark.sql import functions as F

from tallyframe.plans import nb_search_plans
from tallyframe.sources import views

SF = "/root/testdata/sf0.001"


def test_partitions_of_the_survey_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(views, "ORDERS", 40)
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    s = views.survey(spark, SF).persist()
    rows = s.groupBy(F.spark_partition_id()).count().collect()
    s.unpersist()
    assert sum(r["count"] for r in rows) == orders
    assert len(rows) > orders // 80 and max(r["count"] for r in rows) < 120


def test_scans_that_deal_the_lines_are_bounded(spark, tmp_path, monkeypatch):
    """a task that deals lines held what it read, up to 128 MB of a file."""
    name = "spark.sql.files.maxPartitionBytes"
    (spark.read.parquet(f"{SF}/lineitem.parquet").repartition(1).write.option("parquet.block.size", 16_384)
     .option("parquet.block.size.row.check.min", 100).parquet(f"{tmp_path}/lineitem.parquet"))
    files = [f for f in (tmp_path / "lineitem.parquet").iterdir() if f.suffix == ".parquet"]
    monkeypatch.setattr(views, "SCAN_BYTES", 20_000)
    before = spark.conf.get(name)
    try:
        views.survey(spark, SF)
        assert spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions() >= sum(f.stat().st_size for f in files) // 20_000
        for own, kept in (("10k", "10k"), ("1m", "20000"), ("134217728b", "20000"), ("19999", "19999")):
            spark.conf.set(name, own)
            views.survey(spark, SF)
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def test_answers_are_kept_and_not_their_words(spark):
    _, present, model = nb_search_plans._survey_parts(spark, SF, ["movie", "drink"])
    assert not present.storageLevel.useMemory and not present.storageLevel.useDisk
    model.theta.unpersist()


def test_words_are_counted_where_their_text_lies(spark):
    from tallyframe.operators.text import TEXTS, by_id, word_counts
    docs = spark.createDataFrame([(1, "a b a"), (1, "A c"), (2, None), (3, ""), (4, "ß_1 ß_1")], "id bigint, text string")
    assert sorted(map(tuple, word_counts(docs).collect())) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (4, "ß_1", 2)]
    many = spark.range(TEXTS * 20).select("id", F.lit("x").alias("text"))
    assert by_id(many).rdd.getNumPartitions() >= 20
    # the only exchange is that of the texts
    plan = word_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_sketches_read_each_word_of_a_month_once(spark, monkeypatch):
    from tallyframe.plans import search_plans
    seen = []
    monkeypatch.setattr(search_plans, "token_sketches", lambda tok, keys: seen.append(tok) or search_plans.tx_sketches(tok, keys))
    monkeypatch.setattr(search_plans, "tx_sketches", __import__("tallyframe.operators.text", fromlist=["x"]).token_sketches, raising=False)
    assert search_plans.q_vocab_size_sketch(spark, SF).count() == 8
    assert seen[0].count() == seen[0].select("question", "month", "token").distinct().count()
