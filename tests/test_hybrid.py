"""Hybrid models: k folds at once against one fold after another, searches and their candidates."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import foldwise, hybrid, softmax_batch as sb
from tallyframe.sources.tables import scratch, stored

from test_foldwise import survey

NUM, CATE, TEXT = ["price"], ["setting"], ["movie"]
PRIORS, STRENGTHS = [(1.0, 3.0), (0.5, 0.5)], [0.01, 1.0]
FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    """Answers that tell the class in part; every row has one of three folds."""
    out = [(i, p, s, " ".join(filter(None, [m, ["alpha", "beta", "gamma"][y] if i % 5 else None])), y, i * 7 % FOLDS) for i, p, _, s, m, _, y, _ in survey(150)]
    return spark.createDataFrame(out, "id bigint, price string, setting string, movie string, y int, fold int").persist()


def build(df, views):
    return hybrid.build(df, 3, FOLDS, views, NUM, CATE, TEXT, TEXT, PRIORS, STRENGTHS)


def test_folds_at_once_equal_separate_fits(spark, rows):
    outers = [frozenset({f}) for f in range(FOLDS)]
    data = build(rows, hybrid.nested_views(outers, FOLDS))
    chosen = hybrid.search_strength(data, STRENGTHS, outers)
    got = {r["problem"]: (r["n"], r["hits"]) for r in sb.hits(data.blocks, hybrid.final_fits(data, [c for c, _ in chosen], outers)).collect()}
    for f in (1,):
        # the fold's rows as rows without a fold, the others' folds as they are
        alone = rows.withColumn("fold", F.when(F.col("fold") == f, -1).otherwise(F.col("fold")))
        here = build(alone, [frozenset(), *[frozenset({g}) for g in range(FOLDS) if g != f]])
        problems = []
        for c in STRENGTHS:
            for g in range(FOLDS):
                if g != f:
                    v = here.views.index(frozenset({g}))
                    problems.append(sb.Problem(c, None, tuple(x for x in here.inner(v) if x % FOLDS != f), (v * FOLDS + g,)))
        share = {r["problem"]: r["hits"] / r["n"] for r in sb.hits(here.blocks, sb.fit(here.blocks, here.width, 3, problems, hybrid.TOLERANCE)).collect()}
        means = [(share[2 * i] + share[2 * i + 1]) / 2 for i in range(2)]
        assert chosen[f] == (STRENGTHS[sb.first_best(means)], pytest.approx(means[sb.first_best(means)]))
        last = sb.fit(here.blocks, here.width, 3, [sb.Problem(chosen[f][0], None, tuple(here.inner(0)), (-1,))])
        [r] = sb.hits(here.blocks, last).collect()
        assert got[f] == (r["n"], r["hits"])
    assert sum(n for n, _ in got.values()) == 150 and sum(h for _, h in got.values()) > 75


def test_probabilities_come_from_other_folds(spark, rows):
    """A row's own label doesn't change its probability blocks."""
    views = [frozenset()]
    one = build(rows, views)
    turned = rows.withColumn("y", F.when(F.col("id") == 30, (F.col("y") + 1) % 3).otherwise(F.col("y")))
    two = build(turned, views)
    pick = lambda d: {r["id"]: [v for c, v in zip(r["columns"], r["vals"]) if any(a <= c < b for a, b in d.prob.values())] for r in d.entries.collect()}
    a, b = pick(one), pick(two)
    fold = {r["id"]: r["fold"] for r in rows.collect()}
    assert a[30] == pytest.approx(b[30], abs=1e-6) and len(a[30]) == 6
    assert any(a[i] != pytest.approx(b[i], abs=1e-6) for i in a if fold[i] != fold[30])


def test_searches_mark_the_first_best(spark, rows):
    data = build(rows, hybrid.nested_views([frozenset()], FOLDS))
    grid = hybrid.representation_grid({"price": ("none", "raw"), "movie": ("none", "raw", "prob"), "setting": ("none", "raw", "prob")})
    assert len(grid) == 17 and all(any(r != "none" for r in g.values()) for g in grid)
    where = {"raw": data.raw, "prob": data.prob}
    [means] = hybrid.cross_validated(data, [sb.Problem(1.0, data.ranges([where[r][q] for q, r in g.items() if r != "none"])) for g in grid])
    best = grid[sb.first_best(means)]
    assert best["movie"] != "none" and means[sb.first_best(means)] > 0.45
    for g, m in [*zip(grid, means)][::5]:
        [[alone]] = hybrid.cross_validated(data, [sb.Problem(1.0, data.ranges([where[r][q] for q, r in g.items() if r != "none"]))])
        assert alone == pytest.approx(m)


def test_candidates_and_loop_flags():
    assert len(hybrid.subset_grid(["a", "b"], ["t"], ["c"])) == 4 * 3
    assert hybrid.subset_grid(["a", "b"], ["t"], ["c"], False, False, False) == [(("a", "b"), ("t",), ("c",))]
    assert hybrid.subset_grid(["a"], [], [], loop_numeric=True) == []
    assert len(hybrid.subset_grid(["a", "b"], ["t"], ["c"], loop_numeric=False)) == 3
    assert len(hybrid.subset_grid(["a", "b"], ["t"], ["c"], loop_categorical=False)) == 4 * 2
    assert hybrid.nested_views([frozenset({0}), frozenset({1})], 3) == [frozenset({0}), frozenset({1}), frozenset({0, 1}), frozenset({0, 2}), frozenset({1, 2})]
