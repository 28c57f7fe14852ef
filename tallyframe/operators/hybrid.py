"""Hybrid models: raw blocks beside cross-fitted class probabilities, under one softmax.

Every question gives a raw block (number, multi-hot or words) and, where it
has one, a block of class probabilities: naive Bayes over its words, or a
softmax over its options.  A training row's probabilities come from models
that never saw its fold, so the last softmax learns from what it will meet.

All training sets of a search (views, see ``foldwise``) share their stored rows
(``viewrows``): the fold code of a row under a view is view * folds + fold, and
the batched softmax fits pick their training and test rows by these codes.  A search inside a training
set has a view of its own for each fold that it keeps out, so that no feature
of the rows that a fit learns from has seen the labels it is tried on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain, combinations, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import tokens
from tallyframe.operators import foldwise, softmax_batch as sb, viewrows
from tallyframe.operators.foldwise import NO_FOLD, Views
from tallyframe.sources.tables import stored

#: Of the gradients of candidate fits; the loss is then within about 1e-8 of its least value.
TOLERANCE = 1e-4

@dataclass
class HybridData:
    """Encoded rows of every view, and where each block of columns lies.

    ``raw``/``prob``: question -> [from, to); ``entries`` (view, id, y, fold
    code, columns, vals), made when asked for; ``blocks``: the same rows for the
    batched fits; ``encoder``: what makes them of the stored ones.
    """

    views: list[frozenset[int]]
    folds: int
    k: int
    raw: dict[str, tuple[int, int]]
    prob: dict[str, tuple[int, int]]
    width: int
    entries: DataFrame
    blocks: sb.Rows
    encoder: viewrows.Encoder | None = None

    def some_entries(self, codes: Sequence[int]) -> DataFrame:
        """``entries`` of some fold codes; no others are made."""
        if self.encoder is None:
            return self.entries.where(F.col("fold").isin([*codes]))
        return viewrows.entries(self.blocks.frame, self.encoder, codes)

    def inner(self, v: int) -> list[int]:
        """Fold codes that a view learns from."""
        return [v * self.folds + f for f in range(self.folds) if f not in self.views[v]]

    def outer(self, v: int) -> tuple[int, ...]:
        """Fold codes that a view is tried on: what it leaves out, or else the rows without a fold."""
        return tuple(v * self.folds + f for f in sorted(self.views[v])) or (NO_FOLD,)

    def crossed(self, candidates: Sequence[sb.Problem], left_out: frozenset[int] = frozenset()) -> tuple[list[sb.Problem], int]:
        """(each candidate with each fold inside a training set kept out, how many folds that are)."""
        out, inside = [], [f for f in range(self.folds) if f not in left_out]
        for c in candidates:
            for f in inside:
                v = self.views.index(left_out | {f})
                out.append(sb.Problem(c.c, c.ranges, tuple(self.inner(v)), (v * self.folds + f,)))
        return out, len(inside)

    def ranges(self, blocks: Sequence[tuple[int, int]]) -> sb.Ranges:
        return tuple(sorted(r for r in blocks if r[1] > r[0]))


def nested_views(outers: Views, folds: int) -> list[frozenset[int]]:
    """The training sets, and each of them without each of its folds."""
    out = [frozenset(o) for o in outers]
    for o in [*out]:
        out += [v for f in range(folds) if f not in o and (v := o | {f}) not in out]
    return out


def fold_code(folds: int):
    return F.when(F.col("fold") >= 0, F.col("view") * folds + F.col("fold")).otherwise(F.lit(NO_FOLD)).cast("int").alias("fold")


def category_probabilities(data: HybridData, questions: Sequence[str], strengths: Sequence[float]) -> tuple[DataFrame, dict[tuple[int, str], float]]:
    """M7: ((view, id, question, prob array[K]), the strength chosen for each (view, question)).

    For each question a softmax over its options; the strength is the first
    best by the accuracy over the view's folds, and the very fits of that
    search, each without a fold, give the probabilities of that fold's rows.
    """
    fits, chosen, owner, best = category_fits(data, questions, strengths)
    of = data.blocks.sparkSession.createDataFrame(owner, "problem int, view int, question string")  # a row a problem
    rows = data.entries.select("id", "fold", "columns", "vals")
    found = sb.probabilities(rows, fits, chosen).join(F.broadcast(of), "problem")
    return found.select("view", "id", "question", "prob"), best


def category_fits(data: HybridData, questions: Sequence[str], strengths: Sequence[float]) -> tuple[sb.Fits, list[int], list[tuple[int, int, str]], dict[tuple[int, str], float]]:
    """(all fits, the chosen problems, (problem, view, question) of these, strength of each (view, question))."""
    cells = [(v, q) for v in range(len(data.views)) for q in questions]
    problems: list[sb.Problem] = []
    tried: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for v, q in cells:
        for c in strengths:
            base, inner = sb.Problem(c, (data.raw[q],) if data.raw[q][1] > data.raw[q][0] else ()), data.inner(v)
            first = len(problems)
            problems += sb.crossed([base], inner) + [sb.Problem(c, base.ranges, tuple(inner), data.outer(v))]
            tried.setdefault((v, q), []).append((first, len(problems)))
    fits = sb.fit(data.blocks, data.width, data.k, problems, TOLERANCE)
    share = {r["problem"]: r["hits"] / r["n"] for r in sb.hits(data.blocks, fits).collect()}  # a row a problem
    chosen, owner, best = [], [], {}
    for cell, runs in tried.items():
        means = []
        for a, b in runs:
            seen = [share[p] for p in range(a, b - 1) if p in share]
            means.append(sum(seen) / len(seen) if seen else 0.0)
        i = sb.first_best(means)
        best[cell] = strengths[i]
        chosen += range(*runs[i])
        owner += [(p, *cell) for p in range(*runs[i])]
    return fits, chosen, owner, best


def answers(df: DataFrame, questions: Sequence[str]) -> DataFrame:
    """(id, y, fold, question, token): the distinct words of each answer, null for answers without words."""
    parts = F.array(*[F.struct(F.lit(q).alias("question"), F.array_distinct(tokens(F.col(q).cast("string"))).alias("t")) for q in questions])
    return df.select("id", "y", "fold", F.explode(parts).alias("x")).select("id", "y", "fold", "x.question", F.explode_outer("x.t").alias("token"))


def build(df: DataFrame, k: int, folds: int, views: Views, num_cols: Sequence[str], cate_cols: Sequence[str], text_cols: Sequence[str],
          nb_cols: Sequence[str], priors: Sequence[tuple[float, float]], strengths: Sequence[float]) -> HybridData:
    """M8: encode ``df`` (id, y, fold and the questions) under every view.

    ``nb_cols``: questions with a naive Bayes block (prior chosen by view and
    question among ``priors``); every multi-select question has a softmax block
    (strength chosen among ``strengths``).
    """
    views = [frozenset(v) for v in views]
    features = foldwise.fit_features(df, views, folds, num_cols, cate_cols, text_cols)
    prob, width = {}, features.width
    for q in [*nb_cols, *[q for q in cate_cols if q not in nb_cols]]:
        prob[q] = (width, width + k)
        width += k
    mask, named = viewrows.column_masks(features)
    impute = {v: {features.ranges[q][0]: features.impute[v, q] for q in num_cols} for v in range(len(views))}
    encoder = viewrows.Encoder(views, folds, k, width, features.width, mask, impute)
    # numbers, options and words are made once
    made = stored(df.select("id", "y", "fold", *viewrows.answer_columns(features, nb_cols)), "answers")
    counts = frequent = None
    if nb_cols:
        counts, frequent = viewrows.naive_bayes(encoder, made, nb_cols, [prob[q][0] for q in nb_cols], priors, folds, k)
    frame = viewrows.store_rows(made, features, named, nb_cols, counts, frequent, folds, k)
    if nb_cols:
        encoder.prior = viewrows.choose_priors(encoder, frame)
    only = [q for q in cate_cols if q not in nb_cols]
    if only:
        plain = viewrows.Encoder(views, folds, k, features.width, features.width, mask, impute, questions=[*nb_cols])
        small = HybridData(views, folds, k, features.ranges, {}, features.width, viewrows.entries(frame, plain), viewrows.expanded(frame, plain), plain)
        fits, _, owner, _ = category_fits(small, only, strengths)
        for p, v, q in owner:
            a, b = features.ranges[q]
            for code in fits.problems[p].test:
                encoder.weights.setdefault((v, code % folds if code >= 0 else NO_FOLD), {})[prob[q][0]] = (a, b, fits.weights[p][:, a:b].T, fits.bias[p])
    return HybridData(views, folds, k, features.ranges, prob, width, viewrows.entries(frame, encoder), viewrows.expanded(frame, encoder), encoder)


# --- candidates -------------------------------------------------------------------


def subsets(items: Sequence[str], loop: bool) -> list[tuple[str, ...]]:
    """All subsets, the small ones first; only the whole where a loop is switched off."""
    return [*chain.from_iterable(combinations(items, n) for n in range(len(items) + 1))] if loop else [tuple(items)]


def subset_grid(num_cols: Sequence[str], text_cols: Sequence[str], cate_cols: Sequence[str], loop_numeric: bool = True,
                loop_text: bool = True, loop_categorical: bool = True) -> list[tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]]:
    """(numbers, texts, multi-selects) to try; those without a text and a multi-select question are skipped."""
    every = product(subsets(num_cols, loop_numeric), subsets(text_cols, loop_text), subsets(cate_cols, loop_categorical))
    return [(n, t, c) for n, t, c in every if t or c]


def representation_grid(options: dict[str, Sequence[str]]) -> list[dict[str, str]]:
    """The product of the representations of each question, without the one that uses none."""
    names = [*options]
    return [dict(zip(names, reps)) for reps in product(*options.values()) if any(r != "none" for r in reps)]


# --- searches ---------------------------------------------------------------------


def cross_validated(data: HybridData, candidates: Sequence[sb.Problem], outers: Views = (frozenset(),), tolerance: float = TOLERANCE) -> list[list[float]]:
    """By training set: the mean accuracy of each candidate over its folds; all fits share their passes."""
    problems, spans = [], []
    for o in outers:
        more, inside = data.crossed(candidates, frozenset(o))
        spans.append((len(problems), inside))
        problems += more
    fits = sb.fit(data.blocks, data.width, data.k, problems, tolerance)
    share = {r["problem"]: r["hits"] / r["n"] for r in sb.hits(data.blocks, fits).collect()}  # a row a problem
    out = []
    for first, inside in spans:
        seen = [[share[p] for p in range(first + i * inside, first + (i + 1) * inside) if p in share] for i in range(len(candidates))]
        out.append([sum(s) / len(s) if s else 0.0 for s in seen])
    return out


def search_strength(data: HybridData, strengths: Sequence[float], outers: Views = (frozenset(),), ranges: sb.Ranges | None = None) -> list[tuple[float, float]]:
    """(chosen C, its mean accuracy) of each training set, by its own folds; the first best wins."""
    out = []
    for means in cross_validated(data, [sb.Problem(c, ranges) for c in strengths], outers):
        i = sb.first_best(means)
        out.append((strengths[i], means[i]))
    return out


def final_fits(data: HybridData, chosen: Sequence[float], outers: Views = (frozenset(),), ranges: sb.Ranges | None = None) -> sb.Fits:
    """The fit of each training set on all of it, to be tried on what it leaves out."""
    at = [data.views.index(frozenset(o)) for o in outers]
    return sb.fit(data.blocks, data.width, data.k, [sb.Problem(c, ranges, tuple(data.inner(v)), data.outer(v)) for v, c in zip(at, chosen)])
