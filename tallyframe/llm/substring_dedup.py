"""Operator 2: exact substring dedup by seed and extend.

A word is removed when a window of ``WINDOW`` consecutive words covers it that
also starts earlier (in a document with a smaller id, or further up in the
same one).

Seeds: every window has an anchor, the smallest hash of the ``SEED``-word runs
in it (winnowing), so equal windows have equal anchors.  Anchors are counted
over all documents; those that one document alone has can't seed a repeat.
Documents meet on the others: through a broadcast of them where they are at
most ``BROADCAST_ANCHORS``, through a shuffle join beyond that.

Extension: from each seed the match is carried on to both sides, one window at
a time, as long as the window still holds the anchor.  Each of these windows
is matched, by 96 bits of two polynomial hashes over its words, with the first
document that has it; matched windows that overlap or touch make the maximal
repeats, which the later document loses.  Occurrences are matched with the
first one only, never with each other, and windows of a frequent anchor are
salted before they are compared.

Edge cases: null texts have no words; texts under ``WINDOW`` words lose
nothing; rows without an id come after all others; rows that share an id are
one document: neither is earlier, and none loses words to the other; repeated
rows get equal results; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import pick, prepare, shared, stored

WINDOW = 20
SEED = 8
#: Anchors (8 bytes and a flag) that may be broadcast.
BROADCAST_ANCHORS = 4_000_000
#: An anchor of so many documents is salted, over so many values.
HOT = 1000
SALTS = 64
#: Words a task looks at together, and hashes of words it keeps.
GROUP_WORDS = 400_000
CACHE_WORDS = 200_000
#: Stands for the id of rows without one.
LAST = (1 << 63) - 1

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


def runs(h: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hashes (mod 2**64) of all runs of ``length`` words, by doubling."""
    done, size, part, width = None, 0, h, 1
    while True:
        if length & width:
            if done is None:
                done, size = part, width
            else:
                n = len(h) - size - width + 1
                done = done[:n] + part[size:size + n] * np.uint64(pow(base, size, 1 << 64))
                size += width
        width *= 2
        if width > length:
            return done
        half = width // 2
        n = len(h) - width + 1
        part = part[:n] + part[half:half + n] * np.uint64(pow(base, half, 1 << 64))


def lowest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` consecutive values."""
    width, part = 1, values
    while 2 * width <= span:
        part = np.minimum(part[:len(part) - width], part[width:])
        width *= 2
    n = len(values) - span + 1
    return np.minimum(part[:n], part[span - width:span - width + n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Windows:
    """Windows of some texts: which text, start, anchor and the two hashes."""

    def __init__(self, texts: list[list[bytes]], hashes: WordHashes, window: int = WINDOW, seed: int = SEED):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        total = int(lengths.sum())
        h = np.fromiter((hashes[w] for t in texts for w in t), np.uint64, total)
        text = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        if total < window:
            self.text = self.start = np.zeros(0, np.int64)
            self.anchor = self.key = self.check = np.zeros(0, np.uint64)
            return
        whole = text[:total - window + 1] == text[window - 1:]
        self.text, self.start = text[:len(whole)][whole], place[:len(whole)][whole]
        self.anchor = lowest(mixed(runs(h, seed, _BASES[0])), window - seed + 1)[whole]
        self.key = mixed(runs(h, window, _BASES[0]))[whole]
        self.check = mixed(runs(h ^ (h >> np.uint64(31)), window, _BASES[1]))[whole] >> np.uint64(32)


def row_groups(batches: Iterator[pa.RecordBatch]):
    """Rows of the batches, with their words, ``GROUP_WORDS`` or a little more at a time."""
    rows, texts, size = [], [], 0
    for batch in batches:
        *columns, text = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for row, t in zip(zip(*columns), text):
            words = (t or "").encode().split()
            rows.append(row)
            texts.append(words)
            size += len(words)
            if size >= GROUP_WORDS:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def anchors_of(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(doc, row, anchor): the distinct anchors of each row."""

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows, texts in row_groups(batches):
            w = Windows(texts, hashes, window, seed)
            first = np.ones(len(w.text), bool)
            first[1:] = (w.anchor[1:] != w.anchor[:-1]) | (w.text[1:] != w.text[:-1])
            doc, row = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[w.text[first]]), pa.array(row[w.text[first]].astype(np.int32)), pa.array(w.anchor[first].view(np.int64))],
                ["doc", "row", "anchor"])

    return docs.mapInArrow(winnow, "doc bigint, row int, anchor bigint")


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Order of a document, and a digest that tells rows with one id apart."""
    return [F.coalesce(doc_id, F.lit(LAST)).cast("bigint").alias("doc"), F.hash(text).alias("row")]


FOUND = "doc bigint, row int, start int, key bigint, check int, hot boolean"


def extended(docs: DataFrame, held, window: int, seed: int) -> DataFrame:
    """Windows around seeds: the first of each kind in its row, with its hashes.

    A window that repeats one further up in its own row has a null key.
    ``held`` is a broadcast (sorted anchors, hot flags); without it each row
    brings its own anchors and flags as columns.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows, texts in row_groups(batches):
            w = Windows(texts, hashes, window, seed)
            n = len(w.text)
            order = np.lexsort((w.start, w.check, w.key, w.text))
            again = np.zeros(n, bool)
            a, b = order[1:], order[:-1]
            again[a] = (w.text[a] == w.text[b]) & (w.key[a] == w.key[b]) & (w.check[a] == w.check[b])
            seeded, hot = np.zeros(n, bool), np.zeros(n, bool)
            mine = w.anchor.view(np.int64)
            if held is not None:
                known, flags = held.value
                if len(known):
                    at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                    seeded, hot = known[at] == mine, flags[at]
            else:
                edges = np.searchsorted(w.text, np.arange(len(rows) + 1))
                for i, r in enumerate(rows):
                    s = slice(edges[i], edges[i + 1])
                    seeded[s], hot[s] = np.isin(mine[s], r[2] or []), np.isin(mine[s], r[3] or [])
            out = np.flatnonzero(seeded | again)
            doc, row = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[w.text[out]]), pa.array(row[w.text[out]].astype(np.int32)), pa.array(w.start[out].astype(np.int32)),
                 pa.array(w.key.view(np.int64)[out], mask=again[out]), pa.array(w.check[out].astype(np.uint32).view(np.int32)),
                 pa.array(hot[out] & seeded[out])], ["doc", "row", "start", "key", "check", "hot"])

    return docs.mapInArrow(extend, FOUND)


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, broadcast_anchors: int = BROADCAST_ANCHORS,
            hot: int = HOT) -> DataFrame:
    """(doc, row, start): windows that start earlier somewhere else."""
    spark = docs.sparkSession
    prepare(spark)
    source = pick(docs, "doc_id", "text").select(*row_key(F.col("doc_id"), F.col("text")), "text")
    seeds = anchors_of(source, window, seed)
    several = shared(seeds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
                     .select("anchor", (F.col("n") >= hot).alias("hot")))
    if several.count() <= broadcast_anchors:
        table = several.toArrow()  # bounded by the check above
        known, flags = table.column("anchor").to_numpy(), table.column("hot").to_numpy(zero_copy_only=False)
        order = np.argsort(known)
        found = extended(source, spark.sparkContext.broadcast((known[order], flags[order].astype(bool))), window, seed)
    else:
        own = (seeds.distinct().join(several, "anchor").groupBy("doc", "row")
               .agg(F.collect_list("anchor").alias("anchors"), F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("frequent")))
        joined = source.join(own, ["doc", "row"], "left").select("doc", "row", "anchors", "frequent", "text")
        found = extended(joined, None, window, seed)
    found = found.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc"), F.lit(SALTS))).otherwise(0))
    by_salt = Window.partitionBy("key", "check", "salt")
    inner = found.withColumn("first", F.when(F.col("key").isNotNull(), F.min("doc").over(by_salt)))
    gone = F.col("key").isNull() | (F.col("doc") > F.col("first"))
    # answers of this level, and the first rows of each salt of a frequent anchor's windows
    inner = stored(inner.select("doc", "row", "start", F.when(~gone, F.col("key")).alias("key"), F.when(~gone, F.col("check")).alias("check"), "hot")
                   .where("hot or key is null"), "repeats")
    heads = inner.where("key is not null")
    heads = heads.withColumn("first", F.min("doc").over(Window.partitionBy("key", "check")))
    return inner.where("key is null").select("doc", "row", "start").unionByName(
        heads.where("doc > first").select("doc", "row", "start"))


def without_repeats(texts: list[str | None], starts: list[list[int] | None], window: int) -> Iterator[tuple[int, int, bytes]]:
    """(words, removed words, kept words joined by one blank) of each text."""
    for text, at in zip(texts, starts):
        words = (text or "").encode().split()
        if not at:
            yield len(words), 0, b" ".join(words)
            continue
        edge = np.zeros(len(words) + 1, np.int64)
        begin = np.array(sorted(set(at)))
        edge[begin] += 1
        np.subtract.at(edge, np.minimum(begin + window, len(words)), 1)
        stays = np.cumsum(edge[:-1]) == 0
        kept = [w for w, s in zip(words, stays.tolist()) if s]
        yield len(words), len(words) - len(kept), b" ".join(kept)


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED, broadcast_anchors: int = BROADCAST_ANCHORS,
                    hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) of every row."""
    gone = repeats(docs, window, seed, broadcast_anchors, hot).groupBy("doc", "row").agg(F.collect_set("start").alias("starts"))

    @arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = [{"n_words": n, "n_removed": r, "kept": k.decode()}
               for n, r, k in without_repeats(texts.to_pylist(), starts.to_pylist(), window)]
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    source = pick(docs, "doc_id", "text").select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    done = source.join(gone, ["doc", "row"], "left").select("doc_id", cut("text", "starts").alias("c"))
    return done.select("doc_id", "c.n_words", "c.n_removed", "c.kept")


def report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    out = substring_dedup(docs, **settings)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS t FROM documents),
win AS (SELECT doc_id, s, md5(list_aggregate(t[s:s + 19], 'string_agg', ' ')) AS k FROM (SELECT doc_id, t, unnest(range(1, len(t) - 18)) AS s FROM w WHERE len(t) >= 20)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM late, range(20) AS x(o)),
words AS (SELECT doc_id, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS p FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(t) AS n_words, len(t) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
