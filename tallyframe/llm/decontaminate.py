"""Operator 5: benchmark decontamination by spaced-seed hashing (DataFrame functions only).

Texts are lower-cased and cut into runs of letters, marks and digits.  A
window is ``WINDOW`` consecutive tokens; two windows overlap when at least
``share`` of their tokens agree place by place, so some may be substituted.
With at most ``missing`` substitutions and the places dealt into ``missing`` +
2 classes, some mask that ignores ``missing`` classes sees no substitution.
Each fixed mask hashes the places it keeps; test and training hashes are
joined, and the whole window is compared around each hit.  Items shorter than
a window must occur whole and unchanged.

The seeds of a test set are broadcast in blocks of at most ``BLOCK_SEEDS``
rows, one pass over the documents for each block, so what is broadcast is
bounded and no item is left out.  Documents are never joined with each other,
and a passage that a third of them share costs each of them its own hits only.

Edge cases: null and empty texts and items have no tokens and never match; a
null item id counts as one item; rows that agree in id and text are judged
once and get the same answer; empty tables give clean answers or an empty
result; further columns are ignored by ``contamination`` and kept by
``drop_contaminated``.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import own_name, pick, prepare, shared

WINDOW = 13
SHARE = 0.8
#: Seed rows (15 numbers each) that are broadcast at once: 60 MB.
BLOCK_SEEDS = 500_000


def token_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def masks(window: int, share: float) -> list[tuple[int, ...]]:
    """The places that each mask keeps."""
    missing = window - ceil(share * window)
    classes = missing + 2
    return [tuple(p for p in range(window) if p % classes not in ignored)
            for ignored in combinations(range(classes), missing)]


def seed(name: int, tokens: str, at: Column, places) -> Column:
    """Hash of the kept places of the window that starts at ``at``."""
    return F.xxhash64(F.lit(name), *(F.get(F.col(tokens), at + p) for p in places))


def doc_seeds(at: Column, window: int, share: float, short: list[int]) -> Column:
    """Seeds of the windows of a document that start at ``at``; null where one doesn't fit."""
    size = F.size("t")
    return F.array(*(F.when(at + window <= size, seed(i, "t", at, kept)) for i, kept in enumerate(masks(window, share))),
                   *(F.when(at + n <= size, seed(-n, "t", at, range(n))) for n in short))


def item_seeds(at: Column, window: int, share: float, short: list[int]) -> Column:
    """The same of an item; an item shorter than a window has one seed, of all its tokens."""
    size = F.size("t")
    return F.array(*(F.when(at + window <= size, seed(i, "t", at, kept)) for i, kept in enumerate(masks(window, share))),
                   *(F.when((size == n) & (at == 0), seed(-n, "t", at, range(n))) for n in short))


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE,
             block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(doc_id, row, item_id, start): windows of documents that overlap an item's window.

    ``row`` is a digest of the text, ``start`` the window's first token.
    """
    prepare(docs.sparkSession)
    need = ceil(share * window)
    test = shared(pick(items, "item_id", "text").select("item_id", token_hashes(F.col("text")).alias("t"))
                  .where(F.size("t") > 0))
    lengths = test.select(F.size("t").alias("n")).where(F.col("n") < window).distinct().collect()  # fewer than window rows
    short = sorted(r["n"] for r in lengths)

    def windows(table: DataFrame, seeds, *keep: str) -> DataFrame:
        starts = F.explode(F.sequence(F.lit(0), F.size("t") - 1)).alias("start")
        each = table.where(F.size("t") > 0).select(*keep, "t", starts)
        return each.select(*keep, "t", "start", F.explode(seeds(F.col("start"), window, share, short)).alias("seed")).where("seed is not null")

    places = [f"w{i}" for i in range(window)]
    seeds = shared(windows(test, item_seeds, "item_id")
                   .select("item_id", "seed", F.least(F.size("t"), F.lit(window)).alias("length"),
                           *(F.get(F.col("t"), F.col("start") + i).alias(p) for i, p in enumerate(places))).distinct())
    blocks = max(1, ceil(seeds.count() / block_seeds))
    train = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("row"), token_hashes(F.col("text")).alias("t"))
    found = None
    for block in range(blocks):
        few = seeds if blocks == 1 else seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block)
        hits = windows(train, doc_seeds, "doc_id", "row").join(F.broadcast(few), "seed")
        same = sum((F.when(F.get(F.col("t"), F.col("start") + i) == F.col(p), 1).otherwise(0) for i, p in enumerate(places)), F.lit(0))
        agree = F.when(F.col("length") < window, F.col("length")).otherwise(need)
        verified = hits.where(same >= agree).select("doc_id", "row", "item_id", "start")
        found = verified if found is None else found.unionByName(verified)
    return found.distinct()


def contaminated_rows(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(doc_id, row, n_items, first_item, n_windows) of the rows with an overlap."""
    found = overlaps(docs, items, **settings)
    each = found.groupBy("doc_id", "row", "item_id").agg(F.collect_set("start").alias("starts"))
    return each.groupBy("doc_id", "row").agg(
        F.count("*").alias("n_items"), F.min("item_id").alias("first_item"),
        F.size(F.array_distinct(F.flatten(F.collect_list("starts")))).cast("bigint").alias("n_windows"))


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """doc_id, contaminated, n_items, first_item, n_windows of every document.

    ``n_windows``: places of the document where a window overlaps some item;
    ``first_item``: -1 without an item.
    """
    found = contaminated_rows(docs, items, **settings).withColumnsRenamed({"doc_id": "d", "row": "r"})
    rows = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("row"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")
    zero = F.lit(0).cast("bigint")
    return out.select("doc_id", F.col("r").isNotNull().alias("contaminated"), F.coalesce("n_items", zero).alias("n_items"),
                      F.coalesce("first_item", zero - 1).alias("first_item"), F.coalesce("n_windows", zero).alias("n_windows"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of docs without an overlap; all columns stay."""
    mark_id, mark_row = own_name(docs, "llm_id"), own_name(docs, "llm_row")
    found = contaminated_rows(docs, items, **settings).select(F.col("doc_id").alias(mark_id), F.col("row").alias(mark_row))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(n)]) for n in ("doc_id", "text"))
    out = plain.join(found, doc_id.eqNullSafe(F.col(mark_id)) & (F.xxhash64(text) == F.col(mark_row)), "left_anti")
    return out.toDF(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS t FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS t FROM benchmark),
dg AS (SELECT doc_id, p, concat_ws(' ', t[p], t[p + 1], t[p + 2], t[p + 3]) AS g
       FROM (SELECT doc_id, t, unnest(range(1, len(t) - 2)) AS p FROM d WHERE len(t) >= 13)),
bg AS (SELECT item_id, p, concat_ws(' ', t[p], t[p + 1], t[p + 2], t[p + 3]) AS g
       FROM (SELECT item_id, t, unnest(range(1, len(t) - 2)) AS p FROM b WHERE len(t) >= 13)),
diag AS (SELECT DISTINCT doc_id, item_id, dg.p - bg.p AS shift FROM dg JOIN bg USING (g)),
win AS (SELECT doc_id, item_id, shift, unnest(range(greatest(1, 1 - shift), least(len(b.t), len(d.t) - shift) - 11)) AS q, d.t AS dt, b.t AS bt
        FROM diag JOIN d USING (doc_id) JOIN b USING (item_id)),
long_hits AS (SELECT doc_id, item_id, q + shift AS start FROM win
              WHERE list_sum(list_transform(range(13), lambda i: CASE WHEN dt[q + shift + i] = bt[q + i] THEN 1 ELSE 0 END)) >= 11),
short_hits AS (SELECT doc_id, item_id, p AS start
               FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS p FROM d) x JOIN b ON len(b.t) < 13 AND len(b.t) > 0 AND x.t[p:p + len(b.t) - 1] = b.t),
hits AS (SELECT * FROM long_hits UNION SELECT * FROM short_hits),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, min(item_id) AS first_item, count(DISTINCT start) AS n_windows FROM hits GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(first_item, -1) AS first_item, coalesce(n_windows, 0) AS n_windows
FROM documents LEFT JOIN found USING (doc_id)
"""
