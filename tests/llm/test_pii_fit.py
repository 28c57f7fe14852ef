"""The PII trees and thresholds against a fit of the same candidates in memory, and rare personal data far beyond a sample."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import pii


def text(rng):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    body = n(15)
    card = next(body + str(c) for c in range(10) if pii.luhn(body + str(c)))
    return f"call +{n(2)} {n(3)} {n(4)} {n(3)}, card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}, order {n(rng.randint(5, 18))}, host 10.{rng.randrange(256)}.0.{rng.randrange(256)}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return [(i, text(rng)) for i in range(300)]


def test_trees_of_a_table_are_those_of_its_rows(spark, texts):
    docs = spark.createDataFrame(texts + [(None, texts[0][1]), (900, None)], "doc_id bigint, text string")
    found = pii.candidate_counts(docs)
    got = [(i % 3 == 0, good, x) for i, t in texts for good, x in pii.examples(t)]
    assert found.agg(F.sum("n")).first()[0] == len(got)
    x, y, held = np.array([g[2] for g in got]), np.array([float(g[1]) for g in got]), np.array([g[0] for g in got])
    want = pii.boost(x[~held], y[~held], rounds=4)
    trees = pii.boost_table(found.where("not held"), rounds=4)
    assert np.abs(trees.chance(x) - want.chance(x)).max() < 1e-5
    limits = pii.threshold_table(found.where("held"), trees)
    p = trees.chance(x)
    for i, kind in enumerate(pii.KINDS):
        mine = held & (x[:, 0] == i)
        taken = mine & (p >= limits[kind])
        assert limits[kind] == 2.0 or (y[taken].mean() >= pii.PRECISION and y[taken].sum() >= pii.LEAST_HITS)
    assert limits["card"] <= 1


def test_every_document_counts(spark, texts):
    """Personal data only in the 150 documents of the highest hashes of 20,400."""
    ids = [r["id"] for r in spark.range(20_400).orderBy(F.xxhash64("id")).collect()]
    rich = dict(zip(ids[-150:], (t for _, t in texts)))
    docs = spark.createDataFrame([(i, rich.get(i, "no numbers")) for i in ids], "doc_id bigint, text string")
    finder = pii.fit(docs)
    assert finder.trees.trees and finder.thresholds["card"] <= 1
