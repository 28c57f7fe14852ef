"""Fold-keyed parameters against one fit for each training set."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import foldwise as fw
from tallyframe.operators.features import FeatureGenerator

NUM, CATE, TEXT = ["price", "size"], ["setting"], ["movie", "drink"]
VIEWS = [frozenset(), frozenset({0}), frozenset({1, 2}), frozenset({3})]


def survey(n=160, seed=2):
    rng = random.Random(seed)
    words = "red blue green the of tall short fish bird 7up Über".split()
    out = []
    for i in range(n):
        text = lambda k: " ".join(rng.choice(words) + ("" if rng.random() < 0.9 else f"{rng.randrange(40)}") for _ in range(rng.randint(0, k)))
        out.append((i, rng.choice(["3", "about 4.5", "2 to 9", None, "none"]), rng.choice(["1", "", None, "8"]) if i % 4 else None,
                    ", ".join(rng.sample(["a", "b", "c", f"rare{i % 23}"], rng.randint(0, 3))) or None, text(9) or None, text(4),
                    rng.randrange(3), rng.choice([-1, 0, 1, 2, 3])))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(survey(), "id bigint, price string, size string, setting string, movie string, drink string, y int, fold int").persist()


@pytest.mark.parametrize("method", ["binary", "tfidf"])
def test_every_view_equals_its_own_fit(spark, rows, method):
    many = fw.fit_features(rows, VIEWS, 4, NUM, CATE, TEXT, method)
    encoded, layout = many.transform(rows).persist(), many.layout().persist()
    names = {r["feature"]: (r["block"], r["question"], r["token"]) for r in many.columns.collect()}
    names |= {many.ranges[q][0]: ("num", q, None) for q in NUM}
    for v, out in enumerate(VIEWS):
        alone = FeatureGenerator(NUM, CATE, TEXT, method).fit(rows.where((F.col("fold") >= 0) & ~F.col("fold").isin([*out])))
        want_layout = {(r["block"], r["question"], r["token"]): r["feature"] for r in alone.layout().collect()}
        got_layout = {(r["block"], r["question"], r["token"]): r["feature"] for r in layout.where(F.col("view") == v).collect()}
        assert got_layout == want_layout
        back = {f: name for name, f in want_layout.items()}
        want = {(r["id"], back[r["feature"]]): r["value"] for r in alone.transform(rows).collect()}
        got = {(r["id"], names[r["feature"]]): r["value"] for r in encoded.where(F.col("view") == v).collect()}
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def test_no_columns_and_no_rows(spark, rows):
    none = fw.fit_features(rows, VIEWS, 4)
    assert none.width == 0 and none.transform(rows).count() == 0
    empty = fw.fit_features(rows.where("false"), [frozenset()], 4, NUM, CATE, TEXT)
    assert empty.width == 2 and empty.impute == {(0, "price"): 1.0, (0, "size"): 1.0}
    assert empty.transform(rows).where("feature > 1").count() == 0


def brute_posterior(data, left_out, question, row, a, b, k=3):
    train = [r for r in data if r["fold"] >= 0 and r["fold"] not in left_out]
    n = [sum(r["y"] == i for r in train) for i in range(k)]
    vocab = {t for r in train for t in r[question]}
    s = []
    for i in range(k):
        total = math.log((n[i] + 1) / (sum(n) + k))
        for t in vocab:
            theta = (sum(r["y"] == i and t in r[question] for r in train) + a) / (n[i] + a + b)
            total += math.log(theta if t in row[question] else 1 - theta)
        s.append(total)
    e = [math.exp(x - max(s)) for x in s]
    return [x / sum(e) for x in e]


def test_crossfit_is_out_of_fold(spark, rows):
    from tallyframe.functions import tokens
    data = [dict(r.asDict(), movie=set(r["m"] or []), drink=set(r["d"] or []))
            for r in rows.select("id", "y", "fold", tokens(F.col("movie")).alias("m"), tokens(F.col("drink")).alias("d")).collect()]
    present = rows.select("id", "y", "fold", F.explode(F.array(*[F.struct(F.lit(q).alias("question"), F.array_distinct(tokens(F.col(q))).alias("t")) for q in TEXT])).alias("x"))
    present = present.select("id", "y", "fold", "x.question", F.explode_outer("x.t").alias("token"))
    views, cands = [frozenset(), frozenset({2})], [(1.0, 3.0), (0.3, 0.7)]
    got = fw.crossfit_nb(present, rows.select("id", "y", "fold"), 3, 4, views, cands).persist()
    found = {(r["view"], r["id"], r["question"], r["cand"]): r["prob"] for r in got.collect()}
    assert len(found) == len(data) * 2 * 2 * 2
    for (v, out), row, q, c in itertools.product(enumerate(views), data[::3], TEXT, range(2)):
        left = out | ({row["fold"]} if row["fold"] >= 0 else set())
        assert found[v, row["id"], q, c] == pytest.approx(brute_posterior(data, left, q, row, *cands[c]), abs=1e-9)
    best = fw.choose_prior(got, views)
    for v, out in enumerate(views):
        for q in TEXT:
            right = [sum(max(range(3), key=lambda i: (found[v, r["id"], q, c][i], -i)) == r["y"] for r in data if r["fold"] >= 0 and r["fold"] not in out) for c in range(2)]
            kept = best.where((F.col("view") == v) & (F.col("question") == q)).select("cand").distinct().collect()
            assert [r["cand"] for r in kept] == [max(range(2), key=lambda c: (right[c], -c))]
