"""Operator 10: exact dedup on an extendible-hash index (DataFrame functions only).

Texts are equal when identical after white space is deleted.  The index lives
in files of the shared folder: one entry for each key (the first 60 bits of
the SHA-256 of the normalised text) with the row that stays and the group's
size.  A directory of key prefixes starts with one bucket; a bucket with more
keys than ``capacity`` is split by the next prefix bit, which doubles its part
of the directory.  Bucket numbers follow the key order, so the tasks that own
a range of buckets own a range of keys.

Keys are counted after a map-side combine, so a text that fills a third of
the table is one entry.  Rows that share a key are compared byte by byte; keys
under which different texts meet are chained, one entry for each text.

Edge cases: a null text counts as empty; among equal texts the one with most
code points stays, then the smallest id, null ids last; of repeated rows (same
id, same text) one stays; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import pick, prepare, shared

#: Prefix bits of the finest directory; bounds the directory to 2**16 entries.
MAX_DEPTH = 16
#: Hex digits of the SHA-256 that make a key.
KEY_DIGITS = 15
BUCKET_KEYS = 100_000


def without_spaces(text: Column) -> Column:
    """Deletes the characters of [\\x20\\x09-\\x0D]."""
    for c in " \n\t\r\x0b\x0c":
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def directory(counts: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(cell, bucket, depth) from (cell, n): the directory after all doublings.

    ``cell`` is the key's prefix at ``max_depth`` bits.  A bucket of depth d
    covers the cells that agree in the first d bits; it is the shallowest one
    that holds at most ``capacity`` keys, or a single cell.  ``bucket`` is the
    first cell it covers.
    """
    depths = F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    prefix = F.expr(f"shiftleft(shiftright(cell, {max_depth} - depth), {max_depth} - depth)")
    levels = counts.select("cell", "n", depths).withColumn("bucket", prefix)
    fits = (levels.groupBy("depth", "bucket").agg(F.sum("n").alias("keys"))
            .where((F.col("keys") <= capacity) | (F.col("depth") == max_depth)))
    return (levels.join(fits, ["depth", "bucket"])
            .groupBy("cell").agg(F.min(F.struct("depth", "bucket")).alias("b"))
            .select("cell", "b.bucket", "b.depth"))


def exact_dedup(docs: DataFrame, capacity: int = BUCKET_KEYS, key_digits: int = KEY_DIGITS,
                index_dir: str | None = None) -> DataFrame:
    """Row of each document: keep_id, group_size, kept, text_sha256.

    ``index_dir``: where the index files go; a new folder beside the
    checkpoints if None.
    """
    spark = docs.sparkSession
    prepare(spark)
    index_dir = index_dir or f"{spark.sparkContext.getCheckpointDir()}/exact-index-{uuid.uuid4().hex}"
    norm = without_spaces(F.coalesce("text", F.lit("")))

    def key(digest: Column) -> Column:
        return F.conv(F.substring(digest, 1, key_digits), 16, 10).cast("bigint")

    source = pick(docs, "doc_id", "text")
    rows = shared(source
                  .select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("cp"),
                          F.sha2(norm.cast("binary"), 256).alias("text_sha256"))
                  .withColumn("key", key(F.col("text_sha256")))
                  .groupBy("key", "text_sha256", "doc_id", "cp").agg(F.count("*").alias("copies")))

    first = F.struct((-F.col("cp")).alias("cp"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"))

    def entries(table: DataFrame, *by: str) -> DataFrame:
        return (table.groupBy(*by).agg(F.sum("copies").alias("group_size"), F.min(first).alias("keep"))
                .select(*by, "group_size", "keep"))

    grouped = entries(rows, "key")
    bits = 4 * key_digits
    cell = F.expr(f"shiftright(key, {max(0, bits - MAX_DEPTH)})")
    counts = grouped.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    buckets = directory(counts, capacity, min(bits, MAX_DEPTH))
    # at most 2**MAX_DEPTH directory rows of two numbers: bounded, so it may be broadcast
    placed = grouped.withColumn("cell", cell).join(F.broadcast(buckets), "cell").drop("cell")
    placed.repartitionByRange("bucket", "key").write.parquet(f"{index_dir}/entries")
    index = spark.read.schema(placed.schema).parquet(f"{index_dir}/entries")

    # bytes compared: the distinct texts under each key that more than one row has;
    # always by a shuffle, as a broadcast of these keys would grow with the corpus
    several = index.where("group_size > 1").select("key").hint("merge")
    texts = source.select(norm.alias("norm")).withColumn("key", key(F.sha2(F.col("norm").cast("binary"), 256)))
    met = texts.join(several, "key", "left_semi").distinct()
    collided = shared(met.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1").select("key"))

    def answer(table: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
        copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
        stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("cp") == -F.col("keep.cp"))
        return (table.join(found, by)
                .select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", stays.alias("stays"),
                        "text_sha256", copy.alias("copy"))
                .select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256"))

    if collided.isEmpty():
        return answer(rows, index.select("key", "group_size", "keep"), ["key"])
    plain = answer(rows.join(collided, "key", "left_anti"), index.select("key", "group_size", "keep"), ["key"])
    chained = (source.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("cp"), norm.alias("norm"))
               .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
               .withColumn("key", key(F.col("text_sha256")))
               .join(collided, "key", "left_semi")
               .groupBy("key", "norm", "text_sha256", "doc_id", "cp").agg(F.count("*").alias("copies")))
    return plain.unionByName(answer(chained, entries(chained, "key", "norm"), ["key", "norm"]))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST)
"""
