"""Bernoulli Naive Bayes with Beta priors, in long form.

Fit:   pi_k     = (N_k + a_c) / (N + K a_c)
       theta_vk = (n_vk + a) / (N_k + a + b)
Score (sparse identity; cost grows with the words present, not N x V):
       lo_vk  = ln theta_vk - ln(1 - theta_vk)
       base_k = ln pi_k + sum_v ln(1 - theta_vk)
       s(id,k) = base_k + sum over words v of the row that are in the vocabulary of lo_vk

Theta is kept wide: one row per token with an ``array<double>`` of K values,
so counting is one ``groupBy(token)`` with map-side combine and scoring is
one equi-join on token followed by one ``groupBy(id)``.  K (the class count)
and the K-vectors N_k, pi, base are bounded parameters held on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import softmax_batch as sb
from tallyframe.operators.text import token_table
from tallyframe.sources.tables import stored

#: The most frequent words of ``search_cells``, which meet the rows by a broadcast.
FREQUENT = 50_000
#: Rows that a task of ``search_cells`` scores at once.
ROWS = 1_024


@dataclass
class NBModel:
    classes: list[str]
    class_counts: list[int]
    prior: list[float]
    theta: DataFrame  # (token, theta array<double>[K])
    a: float
    b: float

    @property
    def k(self) -> int:
        return len(self.classes)


def class_counts(labeled: DataFrame, k: int, y_col: str = "y") -> list[int]:
    """N_k for k in 0..K-1 (one small aggregate)."""
    got = {r[0]: r[1] for r in labeled.groupBy(y_col).count().collect()}
    return [int(got.get(i, 0)) for i in range(k)]


def count_array(y: Column, k: int, weight: Column | None = None) -> Column:
    """K conditional sums as one ``array<bigint>`` aggregate."""
    w = weight if weight is not None else F.lit(1)
    return F.array(*[F.sum(F.when(y == i, w).otherwise(0)).cast("bigint") for i in range(k)])


def token_class_counts(present: DataFrame, k: int, y_col: str = "y") -> DataFrame:
    """A15 (X^T Y): (token, n array<bigint>[K]) from distinct (id, y, token)."""
    return (present.where(F.col("token").isNotNull())
            .groupBy("token").agg(count_array(F.col(y_col), k).alias("n")))


def fit(present: DataFrame, labeled: DataFrame, classes: list[str], a_class: float = 1.0,
        a: float = 1.0, b: float = 3.0, vocab: DataFrame | None = None, y_col: str = "y") -> NBModel:
    """M1.  ``present``: distinct (id, y, token) of the training rows;
    ``labeled``: (id, y) of the training rows (for N_k).  Without ``vocab``
    the vocabulary is every word of the training rows."""
    if a <= 0 or b <= 0 or a_class <= 0:
        raise ValueError("a, b and a_class must be > 0")
    k = len(classes)
    nk = class_counts(labeled, k, y_col)
    n = sum(nk)
    prior = [(nk[i] + a_class) / (n + k * a_class) for i in range(k)]
    counts = token_class_counts(present, k, y_col)
    if vocab is not None:
        zeros = F.array(*[F.lit(0).cast("bigint")] * k)
        counts = (vocab.select("token").join(counts, "token", "left")
                  .select("token", F.coalesce("n", zeros).alias("n")))
    denom = F.array(*[F.lit(float(nk[i] + a + b)) for i in range(k)])
    theta = counts.select("token", F.zip_with("n", denom, lambda c, d: (c + F.lit(a)) / d).alias("theta"))
    # read twice (base sums, scoring join); recomputable from its lineage if lost
    return NBModel(classes, nk, prior, theta.persist(), a, b)


def log_odds_table(model: NBModel) -> tuple[DataFrame, list[float]]:
    """(token, lo array) and the K base scores (one small aggregate)."""
    k = model.k
    th = model.theta
    log1m = F.transform("theta", lambda t: F.log1p(-t))
    sums = th.agg(*[F.sum(F.get(log1m, i)).alias(f"s{i}") for i in range(k)]).collect()[0]
    base = [math.log(model.prior[i]) + float(sums[i] or 0.0) for i in range(k)]
    lo = th.select("token", F.transform("theta", lambda t: F.ln(t) - F.log1p(-t)).alias("lo"))
    return lo, base


def score(present: DataFrame, model: NBModel, keep: list[str] | None = None) -> DataFrame:
    """M2 log scores: (id, *keep, s array<double>[K]).

    ``present``: distinct (id, *keep, token) with token NULL for rows
    without words (``token_table(..., outer=True)``), so every row scores.
    """
    keep = keep or []
    k = model.k
    lo, base = log_odds_table(model)
    j = present.join(lo, "token", "left")
    sums = [F.sum(F.coalesce(F.get(F.col("lo"), i), F.lit(0.0))) for i in range(k)]
    agg = j.groupBy("id", *keep).agg(F.array(*sums).alias("_sum"))
    basec = F.array(*[F.lit(x) for x in base])
    return agg.select("id", *keep, F.zip_with(basec, "_sum", lambda x, y: x + y).alias("s"))


def _let(x: Column, body) -> Column:
    """``body(x)`` with x computed once, however often the body names it."""
    return F.get(F.transform(F.array(x), body), 0)


def softmax(s) -> Column:
    """W4 on an array column: max shift, exp, normalise.

    A lambda computes what it names once for each element, so scores, maximum,
    exponentials and their sum are bound first."""
    s = F.col(s) if isinstance(s, str) else s
    shifted = lambda v: _let(F.array_max(v), lambda m: F.transform(v, lambda x: F.exp(x - m)))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return _let(s, lambda v: _let(shifted(v), lambda e: _let(total(e), lambda z: F.transform(e, lambda x: x / z))))


def argmax(s) -> Column:
    """Index of the largest score, first class on ties."""
    s = F.col(s) if isinstance(s, str) else s
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def predict(scores: DataFrame) -> DataFrame:
    return scores.withColumn("pred", argmax("s"))


def present_table(df: DataFrame, y: Column | None = None, text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """Distinct (id[, y], token) of each row, NULL token for rows without words."""
    keep = list(keep or [])
    src = df if y is None else df.withColumn("y", y)
    cols = keep + (["y"] if y is not None else [])
    return token_table(src, "id", text_col, keep=cols, distinct=True, outer=True)


# --- grouped NB: one model per question (M4) --------------------------------

def fit_grouped(present: DataFrame, labeled: DataFrame, classes: list[str], group: str,
                a_class: float = 1.0, a: float = 1.0, b: float = 3.0, y_col: str = "y") -> NBModel:
    """M1 for every value of ``group`` at once (e.g. one model per question).
    ``present``: distinct (id, y, group, token).  Theta has the group column."""
    k = len(classes)
    nk = class_counts(labeled, k, y_col)
    n = sum(nk)
    prior = [(nk[i] + a_class) / (n + k * a_class) for i in range(k)]
    counts = (present.where(F.col("token").isNotNull())
              .groupBy(group, "token").agg(count_array(F.col(y_col), k).alias("n")))
    denom = F.array(*[F.lit(float(nk[i] + a + b)) for i in range(k)])
    theta = counts.select(group, "token", F.zip_with("n", denom, lambda c, d: (c + F.lit(a)) / d).alias("theta"))
    return NBModel(classes, nk, prior, theta.persist(), a, b)


def score_parts(present: DataFrame, model: NBModel, group: str, keep: list[str] | None = None,
                with_prior: bool = False) -> DataFrame:
    """Per-group log-likelihood parts: (id, group, *keep, part array[K]) with
    ``part = sum_v ln(1-theta) + sum_{v in row} lo`` (no prior unless asked).
    The per-group base sums are one small aggregate (groups x K)."""
    keep = keep or []
    k = model.k
    th = model.theta
    log1m = F.transform("theta", lambda t: F.log1p(-t))
    rows = th.groupBy(group).agg(*[F.sum(F.get(log1m, i)).alias(f"s{i}") for i in range(k)]).collect()
    base = {r[0]: [float(r[i + 1]) for i in range(k)] for r in rows}
    lo = th.select(group, "token", F.transform("theta", lambda t: F.ln(t) - F.log1p(-t)).alias("lo"))
    j = present.join(lo, [group, "token"], "left")
    sums = [F.sum(F.coalesce(F.get(F.col("lo"), i), F.lit(0.0))) for i in range(k)]
    agg = j.groupBy("id", group, *keep).agg(F.array(*sums).alias("_sum"))
    zero = [0.0] * k
    bmap = F.create_map(*[x for g, v in base.items() for x in (F.lit(g), F.array(*[F.lit(t) for t in v]))]) \
        if base else None
    bcol = F.coalesce(F.element_at(bmap, F.col(group)), F.array(*[F.lit(t) for t in zero])) if bmap is not None \
        else F.array(*[F.lit(t) for t in zero])
    prior = [math.log(p) if with_prior else 0.0 for p in model.prior]
    pcol = F.array(*[F.lit(t) for t in prior])
    part = F.zip_with(F.zip_with(bcol, "_sum", lambda x, y: x + y), pcol, lambda x, y: x + y)
    return agg.select("id", group, *keep, part.alias("part"))


# --- all candidates and all folds in one job (M20, M21) ----------------------

def search(present: DataFrame, k: int, n_folds: int, candidates: list[tuple[float, float]],
           a_class: float = 1.0, y_col: str = "y", fold_col: str = "fold", group: str | None = None,
           rows: DataFrame | None = None) -> DataFrame:
    """Held-out accuracy of every (candidate, fold) [and group].

    ``present``: distinct (id, y, fold[, group], token) with NULL token for
    rows without words; fold in 0..n_folds-1.  Training counts of fold f are
    ``total - fold_f`` (one pass over the words serves all folds); the
    vocabulary of fold f is every word of its training part.  With ``group``
    (e.g. question x representation) every group is an independent model
    over the same rows, all in the same job.  ``rows`` (id, y, fold), when
    given, supplies the class counts without touching the token table.
    Output ([group,] cand, fold, n, hits).
    """
    g = [group] if group else []
    c_n = len(candidates)
    y, fo = F.col(y_col), F.col(fold_col)
    if rows is None:
        rows = present.select("id", y_col, fold_col).distinct()
    nkf = {(r[0], r[1]): int(r[2]) for r in rows.groupBy(fold_col, y_col).count().collect()}
    nk_tr = [[sum(nkf.get((h, i), 0) for h in range(n_folds) if h != f) for i in range(k)] for f in range(n_folds)]
    # per token: counts by (fold, class) as one F*K array
    cnt = (present.where(F.col("token").isNotNull()).groupBy(*g, "token")
           .agg(F.array(*[F.sum(F.when((fo == f) & (y == i), 1).otherwise(0)).cast("bigint")
                          for f in range(n_folds) for i in range(k)]).alias("c")))
    fold_rows = []
    for f in range(n_folds):
        ntr = [sum(F.get(F.col("c"), h * k + i) for h in range(n_folds) if h != f) if n_folds > 1 else F.lit(0).cast("bigint") for i in range(k)]
        fold_rows.append(F.struct(F.lit(f).alias(fold_col), *[x.alias(f"n{i}") for i, x in enumerate(ntr)]))
    facts = [(f, [float(n) for n in nk_tr[f]], [math.log((n + a_class) / (sum(nk_tr[f]) + k * a_class)) for n in nk_tr[f]]) for f in range(n_folds)]
    facts = present.sparkSession.createDataFrame(facts, f"{fold_col} int, _n array<double>, _prior array<double>")  # a row a fold
    per_fold = (cnt.select(*g, "token", F.explode(F.array(*fold_rows)).alias("r")).select(*g, "token", "r.*")
                .where(sum((F.col(f"n{i}") for i in range(k)), F.lit(0)) > 0).join(F.broadcast(facts.select(fold_col, "_n")), fold_col))
    theta = {(ci, i): (F.col(f"n{i}") + F.lit(float(a))) / (F.get("_n", i) + F.lit(float(a + b)))
             for ci, (a, b) in enumerate(candidates) for i in range(k)}
    # read by the base sums and by the scoring join; plain numbers, and the grid is in no literal
    tab = per_fold.select(*g, "token", fold_col, *[(F.ln(t) - F.log1p(-t)).alias(f"lo{ci}_{i}") for (ci, i), t in theta.items()],
                          *[F.log1p(-t).alias(f"no{ci}_{i}") for (ci, i), t in theta.items()]).checkpoint()
    base = tab.groupBy(*g, fold_col).agg(*[F.sum(f"no{ci}_{i}").alias(f"b{ci}_{i}") for ci, i in theta])  # groups x folds rows
    j = present.join(tab.select(*g, "token", fold_col, *[f"lo{ci}_{i}" for ci, i in theta]), [*g, "token", fold_col], "left")
    per_row = j.groupBy("id", y_col, fold_col, *g).agg(*[F.sum(F.coalesce(f"lo{ci}_{i}", F.lit(0.0))).alias(f"s{ci}_{i}") for ci, i in theta])
    scored = per_row.join(base, [*g, fold_col], "left").join(F.broadcast(facts.select(fold_col, "_prior")), fold_col)
    hits = []
    for ci in range(c_n):
        s = F.array(*[F.get("_prior", i) + F.coalesce(f"b{ci}_{i}", F.lit(0.0)) + F.col(f"s{ci}_{i}") for i in range(k)])
        hits.append(F.sum((argmax(s) == y).cast("bigint")).alias(f"h{ci}"))
    # one row for each group and fold before the candidates are dealt out
    total = scored.groupBy(*g, fold_col).agg(F.count(F.lit(1)).alias("n"), *hits)
    cands = F.array(*[F.struct(F.lit(ci).alias("cand"), F.coalesce(f"h{ci}", F.lit(0).cast("bigint")).alias("hits")) for ci in range(c_n)])
    return total.select(*g, fold_col, "n", F.explode(cands).alias("r")).select(*g, "r.cand", fold_col, "n", "r.hits")


def _sums_of(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``lengths`` of them at a time."""
    out = np.zeros((len(lengths), values.shape[1]))
    some = lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[some], axis=0)
    return out


@dataclass
class _Cells:
    """Parameters of ``search_cells`` in a task: the frequent words by cell, their counts by fold and class, base scores."""

    words: dict[int, tuple[pa.Array, np.ndarray]]
    counts: np.ndarray
    sizes: np.ndarray
    candidates: list[tuple[float, float]]
    base: np.ndarray  # (fold + 1, cell, candidate, class)

    def logs(self, n: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of theta and 1 - theta (word, candidate, class) from the counts without a fold; unseen words count for nothing."""
        a, b = np.array(self.candidates, float).T
        rows = np.delete(self.sizes, fold, axis=0).sum(axis=0) if fold >= 0 else self.sizes.sum(axis=0)
        theta = (n[:, None] + a[None, :, None]) / (rows + (a + b)[:, None])[None]
        seen = (n.sum(axis=1) > 0)[:, None, None]
        return np.where(seen, np.log(theta), 0.0), np.where(seen, np.log1p(-theta), 0.0)

    def without(self, counts: np.ndarray, fold: int) -> np.ndarray:
        by_fold = counts.reshape(len(counts), *self.sizes.shape)
        return by_fold.sum(axis=1) - (by_fold[:, fold] if fold >= 0 else 0)

    def odds(self, n: np.ndarray, fold: int) -> np.ndarray:
        yes, no = self.logs(n.astype(float), fold)
        return (yes - no).reshape(len(n), yes.shape[1] * yes.shape[2])

    def right(self, sums: np.ndarray, cell: int, fold: int, y: np.ndarray) -> np.ndarray:
        """Rows of a cell and fold that each candidate gets right; ties go to the smaller class."""
        s = sums.reshape(len(sums), len(self.candidates), -1) + self.base[fold + 1, cell]
        return (s.argmax(axis=2) == y[:, None]).sum(axis=0)


def search_cells(rows: DataFrame, k: int, n_folds: int, candidates: list[tuple[float, float]], a_class: float = 1.0,
                 cells: int | None = None) -> DataFrame:
    """``search`` for every cell and for held-out rows in one pass: (cell, cand, fold, n, hits).

    ``rows`` (id, y, fold, cells array<struct<cell, toks>>): one row an id, read
    twice; toks distinct.  A row of fold f meets the counts of the other folds,
    a row of fold -1 those of all.  A task adds up a row where it reads it: the
    ``FREQUENT`` most frequent words are broadcast.  Only cells that hold
    others are kept, as numbers of their frequent words and the other words
    themselves, and those meet their counts by a shuffle and come back to their
    row as K counts each.  No score of a row is stored or sent.  ``cells``: their
    number, looked up in the rows if None.
    """
    spark = rows.sparkSession
    folds = [-1, *range(n_folds)]

    def words(df: DataFrame, *keep: str) -> DataFrame:
        each = df.select("id", "y", "fold", F.explode("cells").alias("c"))
        return each.select(*keep, "c.cell", F.explode("c.toks").alias("token")).where("token is not null")

    # counted by class and fold first: a rare word is sent with one count, not with folds x classes
    slots = (words(rows.where("fold >= 0 and y is not null"), "y", "fold").groupBy("cell", "token", (F.col("fold") * k + F.col("y")).alias("slot"))
             .agg(F.count(F.lit(1)).alias("n")))
    counts = stored(slots.groupBy("cell", "token").agg(
        F.array(*[F.sum(F.when(F.col("slot") == s, F.col("n")).otherwise(0)) for s in range(n_folds * k)]).alias("c"), F.sum("n").alias("total")), "counts")
    sizes = np.zeros((n_folds, k))
    for r in rows.where("fold >= 0 and y is not null").groupBy("fold", "y").count().collect():  # folds x classes
        sizes[r["fold"], r["y"]] = r["count"]
    frequent = counts.orderBy(F.desc("total"), "cell", "token").limit(FREQUENT).toArrow()  # FREQUENT rows
    known = frequent["cell"].to_numpy()
    by_cell = {int(c): (frequent["token"].take(pa.array(np.flatnonzero(known == c))).combine_chunks(), np.flatnonzero(known == c)) for c in np.unique(known)}
    table = np.array(frequent["c"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, n_folds * k).astype(np.int32)
    if cells is None:
        cells = 1 + max((r[0] for r in rows.select(F.max(F.array_max(F.transform("cells", lambda c: c["cell"])))).collect() if r[0] is not None), default=-1)
    zero = np.zeros((n_folds + 1, cells, len(candidates), k))
    light = _Cells({}, table[:0], sizes, [*candidates], zero)

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(zero.shape)
        for b in batches:
            c = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_folds * k)
            of = b.column(0).to_numpy(zero_copy_only=False)
            for f in folds:
                np.add.at(out[f + 1], of, light.logs(light.without(c, f).astype(float), f)[1])
        yield sb._chunks(out)

    base = sb._summed(counts.select("cell", "c").mapInArrow(bases, "chunk int, w binary"), zero.size).reshape(zero.shape)
    for f in folds:
        n = np.delete(sizes, f, axis=0).sum(axis=0) if f >= 0 else sizes.sum(axis=0)
        base[f + 1] += np.log((n + a_class) / (n.sum() + k * a_class))
    cast = spark.sparkContext.broadcast(_Cells(by_cell, table, sizes, [*candidates], base))  # FREQUENT words
    shape = (n_folds + 1, cells, 1 + len(candidates))

    def held(odds: dict[int, np.ndarray], t: _Cells, fold: int) -> np.ndarray:
        if fold not in odds:
            odds[fold] = t.odds(t.without(t.counts, fold), fold)
        return odds[fold]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, odds, found = cast.value, {}, np.zeros(shape)
        names = ["chunk", "w", "id", "y", "fold", "cells"]
        kinds = pa.list_(pa.struct([("cell", pa.int32()), ("known", pa.list_(pa.int32())), ("rest", pa.list_(pa.string()))]))
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                b = whole.slice(at, ROWS)
                y, fold = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                owner = np.repeat(np.arange(len(b)), b.column(3).value_lengths().to_numpy(zero_copy_only=False))
                flat = b.column(3).flatten()
                cell, toks = flat.field("cell").to_numpy(zero_copy_only=False), flat.field("toks")
                kept: list[tuple[int, int, list, list]] = []
                for c in np.unique(cell):
                    mine = np.flatnonzero(cell == c)
                    some = toks.take(pa.array(mine))
                    size = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
                    strings = some.flatten()
                    there = strings.is_valid().to_numpy(zero_copy_only=False)
                    place, of = np.full(len(strings), -1), np.repeat(np.arange(len(mine)), size)
                    if c in t.words and len(strings):
                        hit = pc.index_in(strings, value_set=t.words[c][0])
                        ok = hit.is_valid().to_numpy(zero_copy_only=False) & there
                        place[ok] = t.words[c][1][hit.fill_null(0).to_numpy(zero_copy_only=False)[ok]]
                    lacking = np.bincount(of[(place < 0) & there], minlength=len(mine)) > 0
                    row = owner[mine]
                    for f in np.unique(fold[row]):
                        here = (fold[row] == f) & ~lacking
                        found[f + 1, c, 0] += (fold[row] == f).sum()
                        if here.any():
                            chosen = here[of] & (place >= 0)
                            sums = _sums_of(held(odds, t, int(f))[place[chosen]], np.bincount(of[chosen], minlength=len(mine))[here])
                            found[f + 1, c, 1:] += t.right(sums, c, int(f), y[row[here]])
                    starts = np.cumsum(size) - size
                    for i in np.flatnonzero(lacking):
                        span = slice(starts[i], starts[i] + size[i])
                        p = place[span]
                        new = (p < 0) & there[span]
                        kept.append((int(row[i]), int(c), p[p >= 0].tolist(), strings.slice(starts[i], size[i]).filter(pa.array(new)).to_pylist()))
                if kept:
                    by_row: dict[int, list] = {}
                    for r, c, known_, rest in kept:
                        by_row.setdefault(r, []).append({"cell": c, "known": known_, "rest": rest})
                    at_ = pa.array([*by_row])
                    none = pa.nulls(len(by_row))
                    yield pa.RecordBatch.from_arrays([none.cast(pa.int32()), none.cast(pa.binary()), b.column(0).take(at_), b.column(1).take(at_),
                                                      b.column(2).take(at_), pa.array([*by_row.values()], kinds)], names)
        out = sb._chunks(found)
        none = pa.nulls(len(out))
        yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(kinds)], names)

    source = rows.select(F.col("id").cast("bigint"), F.col("y").cast("int"), F.col("fold").cast("int"), F.col("cells").cast("array<struct<cell:int,toks:array<string>>>"))
    scored = stored(source.mapInArrow(score, "chunk int, w binary, id bigint, y int, fold int, cells array<struct<cell:int,known:array<int>,rest:array<string>>>"), "scored")
    total = sb._summed(scored.where("chunk is not null").select("chunk", "w"), math.prod(shape))

    pending = scored.where("chunk is null").select("id", "y", "fold", "cells")
    long = pending.select("id", "fold", F.explode("cells").alias("c")).select("id", "fold", "c.cell", F.explode("c.rest").alias("token"))
    own = F.array(*[sum((F.when(F.col("fold") == h, F.lit(0).cast("bigint")).otherwise(F.get("c", h * k + i)) for h in range(n_folds)), F.lit(0).cast("bigint")) for i in range(k)])
    met = (long.join(counts.select("cell", "token", "c").hint("merge"), ["cell", "token"]).select("id", "cell", own.alias("n"))
           .where(F.aggregate("n", F.lit(0).cast("bigint"), lambda x, y: x + y) > 0).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("met")))
    known_cells = F.transform("cells", lambda c: F.struct(c["cell"].alias("cell"), c["known"].alias("known")))
    whole = pending.select("id", "y", "fold", known_cells.alias("cells")).join(met.hint("merge"), "id", "left")
    whole = whole.select("y", "fold", "cells", F.coalesce("met", F.array().cast("array<struct<cell:int,n:array<bigint>>>")).alias("met"))

    def late(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, odds, found = cast.value, {}, np.zeros(shape)
        for every in batches:
            for at in range(0, len(every), ROWS):
                b = every.slice(at, ROWS)
                y, fold = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                owner, other = (np.repeat(np.arange(len(b)), b.column(i).value_lengths().to_numpy(zero_copy_only=False)) for i in (2, 3))
                flat, met_ = b.column(2).flatten(), b.column(3).flatten()
                cell, known_ = flat.field("cell").to_numpy(zero_copy_only=False), flat.field("known")
                met_cell = met_.field("cell").to_numpy(zero_copy_only=False)
                n = met_.field("n").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                size = known_.value_lengths().to_numpy(zero_copy_only=False)
                numbers, of = known_.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(cell)), size)
                for f in np.unique(fold):
                    mine = np.flatnonzero(fold[owner] == f)
                    chosen = fold[owner[of]] == f
                    sums = _sums_of(held(odds, t, int(f))[numbers[chosen]], size[mine])
                    rare = np.flatnonzero(fold[other] == f)
                    if len(rare):
                        place = np.full((len(b), cells), -1)
                        place[owner[mine], cell[mine]] = np.arange(len(mine))
                        np.add.at(sums, place[other[rare], met_cell[rare]], t.odds(n[rare], int(f)))
                    for c in np.unique(cell[mine]):
                        at_ = cell[mine] == c
                        found[f + 1, c, 1:] += t.right(sums[at_], c, int(f), y[owner[mine[at_]]])
        yield sb._chunks(found)

    total = (total + sb._summed(whole.mapInArrow(late, "chunk int, w binary"), math.prod(shape))).reshape(shape)
    out = [(c, ci, f, int(total[f + 1, c, 0]), int(total[f + 1, c, 1 + ci])) for f in folds for c in range(cells) if total[f + 1, c, 0] for ci in range(len(candidates))]
    return spark.createDataFrame(out, "cell int, cand int, fold int, n bigint, hits bigint")  # cells x candidates x folds rows
