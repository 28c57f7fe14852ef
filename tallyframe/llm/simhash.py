"""Operator 4: SimHash near-dedup with sharded BK-trees.

Fingerprints that differ in at most ``radius`` bits agree in one of radius+1
bit blocks, so each shard holds the distinct fingerprints that agree in one
block, and one BK-tree answers for a shard: children are keyed by the integer
distance to their parent and a search follows only the edges within the radius
of the query's distance.  Shards go to their queries by a shuffle: a broadcast
of all trees would grow with the corpus.

A shard with more than ``tree_size`` fingerprints (near copies can fill one)
is split again by blocks of its free bits, and so on until few bits are free;
then it can't hold more than 2**free fingerprints.  No link is lost by that:
two fingerprints of the shard differ in at most ``radius`` of the free bits
too.  A tree reports a spanning forest of its links, which has the same
components.

Edge cases: a null text has no words; texts without words share fingerprint
zero; equal fingerprints link; null ids never become a component's id while
another id is there; an empty table gives an empty result; further columns
are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import own_name, pick, shared
from tallyframe.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Most fingerprints of one BK-tree.
TREE_SIZE = 2048
#: Shards with so few free bits aren't split again.
LEAST_FREE = 10

ALL_BITS = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit majority of the shingles' XXH64 values."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), 65536):
        few = zip(starts[i:i + 65536].tolist(), ends[i:i + 65536].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in few], dtype=">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_column(shingle: int):
    """Column function: text -> fingerprint (bigint, two's complement)."""

    @arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([signed(fingerprint(t, shingle)) for t in texts.to_pylist()], pa.int64())

    return fp


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Stored values at most ``radius`` away."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            stored, children = open_nodes.pop()
            d = (stored ^ value).bit_count()
            if d <= radius:
                found.append(stored)
            if children:
                for edge in range(max(1, d - radius), d + radius + 1):
                    if edge in children:
                        open_nodes.append(children[edge])
        return found


def forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links of a shard's fingerprints, less those that close a cycle."""
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for v in values:
        parent[v] = v
        for other in tree.within(v, radius):
            a, b = root(v), root(other)
            if a != b:
                parent[a] = b
                yield v, other
        tree.add(v)


def blocks(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` runs of its free bits added, for each run."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [round(k * len(free) / parts) for k in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cut, cut[1:])]


def links(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(fp) distinct -> (a, b): links that connect what all links connect."""
    masks, leaves = [0], []
    todo = fps.select("fp", F.lit(0).cast("bigint").alias("mask"))
    while True:
        children = {m: blocks(m, radius + 1) for m in masks}
        split = F.create_map(*(F.lit(x) for m, kids in children.items()
                               for x in (signed(m), [signed(k) for k in kids])))
        todo = todo.select("fp", F.explode(split[F.col("mask")]).alias("mask"))
        todo = shared(todo.withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))))
        masks = sorted({k for kids in children.values() for k in kids})
        if min(64 - m.bit_count() for m in masks) <= LEAST_FREE:
            leaves.append(todo)
            break
        sizes = todo.groupBy("mask", "value").agg(F.count("*").alias("n"))
        big = shared(sizes.where(F.col("n") > tree_size).select("mask", "value"))
        if big.isEmpty():
            leaves.append(todo)
            break
        leaves.append(todo.join(big, ["mask", "value"], "left_anti"))
        todo = todo.join(big, ["mask", "value"], "left_semi").select("fp", "mask")
    shards = leaves[0]
    for more in leaves[1:]:
        shards = shards.unionByName(more)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards one after another; rows come sorted by shard."""
        name, held = None, []

        def found() -> list[tuple[int, int]]:
            return [(signed(a), signed(b)) for a, b in forest([v & ALL_BITS for v in held], radius)] if len(held) > 1 else []

        out: list[tuple[int, int]] = []
        for batch in batches:
            for fp, *shard in zip(*(batch.column(c).to_pylist() for c in ("fp", "mask", "value"))):
                if shard != name:
                    out += found()
                    name, held = shard, []
                held.append(fp)
            yield pair_batch(out)
            out = []
        yield pair_batch(out + found())

    dealt = shards.select("fp", "mask", "value").repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return dealt.mapInArrow(search, "a bigint, b bigint")


def pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def fingerprint_components(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(fp, low) with one row a fingerprint -> (fp, component_id): the smallest low reached."""
    members = components(links(fps.select("fp"), radius, tree_size))
    rooted = fps.join(members, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """(doc_id, text) -> (doc_id, fingerprint, component_id)."""
    rows = shared(pick(docs, "doc_id", "text").select("doc_id", fingerprint_column(shingle)("text").alias("fp")))
    fps = shared(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    found = fingerprint_components(fps, radius, tree_size)
    return rows.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of docs of which the id is their group's smallest; all columns stay.

    Rows without id stay only in groups without ids.  Repeated rows (same id)
    all stay; exact dedup is the operator for them.
    """
    mark = own_name(docs, "llm_fp")
    kept = near_duplicates(docs, shingle, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = kept.select(F.col("doc_id").alias(mark)).distinct()
    at = docs.columns.index("doc_id")
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    out = plain.join(ids, plain[f"c{at}"].eqNullSafe(ids[mark]), "left_semi")
    return out.toDF(*docs.columns)
