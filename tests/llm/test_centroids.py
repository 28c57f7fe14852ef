"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from tallyframe.llm import centroids as ce
from tallyframe.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n=150, seed=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 0.4, (5, 64))
    out = [(i, [float(np.float32(x)) for x in centers[i % 5] + rng.normal(0, 0.1, 64)], i) for i in range(n)]
    same = out[3][1]
    out += [(500 + i, same, 0) for i in range(40)]  # a hot vector
    out += [(900, [0.0] * 64, 0), (901, [-1.0 / 64] * 64, 0), (902, [100.5] + [-0.001] * 63, 0)]
    out += [(7, out[7][1], 1), (7, out[8][1], 1), (None, same, 0), (None, out[2][1], 0)]
    return out


BAD = [(1000, None, 0), (1001, [], 0), (1002, [0.5] * 63, 0), (1003, [0.5] * 63 + [None], 0), (1004, [0.5] * 63 + [math.nan], 0),
       (1005, [math.inf] + [0.5] * 63, 0), (1006, [0.5] * 65, 0), (1007, [3e38] + [0.0] * 63, 0)]


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    order = sorted(((i is None, digest(i) if i is not None else "", v) for i, v in kept), key=lambda x: (x[0], x[1], ce.pack(np.array([x[2]]))[0].tobytes()))
    means = [v for _, _, v in order[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    best = lambda v: min((far(v, c), j) for j, c in enumerate(means))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        means = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(means)]
    found = [(i, *best(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i, j, d, sum(e for _, e, g in found if g == j), total, sha[j]) for i, d, j in found), key=str)


@pytest.mark.parametrize("k,rounds", [(16, 3), (4, 1), (300, 2)])
def test_clusters(spark, k, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows + BAD, SCHEMA).repartition(5)
    for few in (df, df.selectExpr("vec_id", "embedding", "label", "1 AS cluster", "2 AS Planes", "3 AS VEC_ID")):
        got = ce.clusters(few, k, rounds)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, rounds)


def test_empty_and_few(spark):
    assert ce.clusters(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ce.clusters(spark.createDataFrame(BAD, SCHEMA)).count() == 0
    one = ce.clusters(spark.createDataFrame([(5, [0.5] * 64, 0)], SCHEMA)).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(5, 0, 0, 0)]


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for most in (1, 2, 64, 127, 128, 5000, 2 ** 29):
        v, c = rng.integers(-most, most, (30, 64)), rng.integers(-most // 2 - 1, most // 2 + 1, (7, 64))
        if most == 2 ** 29:
            v[:, 1:], c[:, 1:] = 0, 0
        assert (ce.unpack(ce.pack(v)) == v).all()
        assert (ce.dots(ce.pack(v), ce.pack(c)) == v @ c.T).all()
        cluster, d = ce.nearest(ce.pack(v), c)
        full = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert (d == full.min(axis=1)).all() and (cluster == full.argmin(axis=1)).all()


def test_rows_of_other_widths():
    import pyarrow as pa

    a, b = np.array([[-3] * 64]), np.array([[500] * 32 + [-7] * 32])
    both = ce.planes_of(pa.array([ce.pack(a)[0].tobytes(), ce.pack(b)[0].tobytes()], pa.binary()))
    assert (ce.unpack(both) == np.concatenate([a, b])).all()


def test_query_equals_sql(spark):
    import duckdb

    where = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_centroids"](spark, where)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{where}/embeddings.parquet'")
    want = duckdb.sql(queries.ORACLE["op13_centroids"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
