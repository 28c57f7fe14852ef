"""Operator 13: centroid clustering on bit planes.

A vector of ``DIMENSION`` integers is kept as bit planes: plane p holds bit p
of every component in one unsigned 64-bit word, in two's complement, so the
last plane weighs -2**p.  The dot product with a centroid is the sum of
weight * weight * popcount(plane AND centroid plane), exact in integers, and
|v|**2 - 2 v.c + |c|**2 is the exact squared distance.

The planes are written once to the shared folder.  Each round is one job over
them: a task adds up the components of each cluster, and at most
clusters * DIMENSION sums reach the driver, which makes the next centroids.

Edge cases: vectors of another length, null ones and those with a null or
non-finite component are left out, as are those whose squared length is
2**60 or more, for which no distance fits a long; repeated rows are clustered
each for itself; null ids are clustered and start a centroid only after all
others; equal hashes are ordered by the vector; fewer vectors than centroids
give fewer centroids; sums of distances beyond a long are null; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import pick, prepare, shared, stored

DIMENSION = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Squared lengths from here on are left out.
LONGEST = 2.0 ** 60


# --- bit planes ---------------------------------------------------------------


def pack(vectors: np.ndarray) -> np.ndarray:
    """(n, 64) integers -> (n, planes) words, as many planes as the largest needs."""
    most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)
    width = most.bit_length() + 1
    bits = [np.packbits((vectors >> p & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8") for p in range(width)]
    return np.concatenate(bits, axis=1)


def unpack(planes: np.ndarray) -> np.ndarray:
    """(n, planes) words -> (n, 64) integers."""
    words, out = np.ascontiguousarray(planes), np.zeros((len(planes), DIMENSION), np.int64)
    for p, weight in enumerate(weights(planes.shape[1])):
        out += weight * np.unpackbits(words[:, p:p + 1].copy().view(np.uint8), axis=1, bitorder="little").astype(np.int64)
    return out


def weights(width: int) -> np.ndarray:
    """Of the planes in two's complement."""
    w = np.left_shift(np.int64(1), np.arange(width, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(n, planes), (k, planes) -> (n, k) exact dot products by AND and popcount.

    A sum may wrap around on its way; the result fits, so it is right.
    """
    out = np.zeros((len(planes), len(centroids)), np.int64)
    with np.errstate(over="ignore"):
        for i, a in enumerate(weights(planes.shape[1])):
            for j, b in enumerate(weights(centroids.shape[1])):
                out += a * b * np.bitwise_count(planes[:, i, None] & centroids[None, :, j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and its squared distance."""
    own = np.zeros(len(planes), np.int64)
    for s in range(0, len(planes), 4096):
        few = unpack(planes[s:s + 4096])
        own[s:s + 4096] = (few * few).sum(axis=1)
    packed = pack(centroids)
    far = own[:, None] - 2 * dots(planes, packed) + (centroids * centroids).sum(axis=1)[None, :]
    cluster = far.argmin(axis=1)
    return cluster, far[np.arange(len(far)), cluster]


def planes_of(column: pa.Array) -> np.ndarray:
    """Binary rows -> (n, planes); rows with fewer planes get their sign plane repeated."""
    rows = [np.frombuffer(b, "<u8") for b in column.to_pylist()]
    width = max(map(len, rows), default=1)
    return np.array([r if len(r) == width else np.append(r, np.repeat(r[-1:], width - len(r))) for r in rows], "<u8").reshape(-1, width)


# --- jobs ---------------------------------------------------------------------


def finite(vector: Column) -> Column:
    """Whether all components are there, finite, and short enough together."""
    short = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * SCALE).cast("double"), 2.0)) < LONGEST
    there = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0 ** 40)))
    return (F.size(vector) == DIMENSION) & there & short


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, planes), only of the vectors that are kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSION)
                words = pack(np.floor(flat * SCALE).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([w.tobytes() for w in words], pa.binary())], ["vec_id", "planes"])

    wide = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding"))
    return wide.where(F.coalesce(finite(F.col("embedding")), F.lit(False))).mapInArrow(rows, "vec_id bigint, planes binary")


def starting(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors whose ids hash lowest."""
    by_hash = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(by_hash.asc_nulls_last(), "planes").limit(k).select("planes").collect()  # k rows
    return unpack(planes_of(pa.array([bytes(r["planes"]) for r in first], pa.binary()))) if first else np.zeros((0, DIMENSION), np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floor of the mean of each centroid's vectors; empty ones stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), DIMENSION), np.int64)
        for b in batches:
            planes = planes_of(b.column(0))
            cluster, _ = nearest(planes, centroids)
            vectors = unpack(planes)
            n += np.bincount(cluster, minlength=len(centroids))
            np.add.at(sums, cluster, vectors)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64()),
                                          pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = rows.select("planes").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    totals = (parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at")
              .agg(wide("n").alias("n"), wide("s").alias("s")).collect())  # k * DIMENSION rows at most
    out = centroids.copy()
    for r in totals:
        out[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "1:") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, the final centroids)."""
    prepare(vectors.sparkSession)
    rows = stored(packed(pick(vectors, "vec_id", "embedding")), "planes")
    centroids = starting(rows, k, salt)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                cluster, distance = nearest(planes_of(b.column(1)), centroids)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                                 ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), centroids


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "1:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    found, centroids = cluster_vectors(vectors, k, rounds, salt)
    found = shared(found)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda s: s if s < 1 << 63 else None
    facts = [(c, fits(sums.get(c, 0)), fits(sum(sums.values())), digest(v)) for c, v in enumerate(centroids)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # k rows
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "1:") -> str:
    """DuckDB SQL of ``clusters`` (vector ids unique)."""
    steps = [f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSION}),
parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM kept),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id)) - 1 AS c, v FROM kept
       ORDER BY sha256('{salt}' || vec_id) LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, unnest(arg_min(struct_pack(c := c, d := d), (d, c))) FROM (
    SELECT k.vec_id, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM kept k, c{i} m) GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, list(m ORDER BY p) AS v FROM (
  SELECT c, p, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
  FROM parts JOIN a{i} USING (vec_id) GROUP BY c, p) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(s{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN s{i} USING (c))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""
