"""Rows of many training sets, stored once.

What the training sets of a search share is stored: the columns that a row
has, and its words.  What tells them apart is made in each task from bounded
parameters: which columns a view knows, the values it imputes, and the class
probabilities that its own models give the row.  So neither disk nor shuffles
grow with the number of training sets, candidates or classes.

The ``WORDS`` first columns and the ``WORDS`` most frequent words are looked up
in the task; the counts of all others meet their rows by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import num_mean, split_options, tokens
from tallyframe.operators import softmax_batch as sb
from tallyframe.operators.foldwise import NO_FOLD, FoldFeatures
from tallyframe.operators.joins import join_rows
from tallyframe.sources.tables import scratch, stored

#: Columns, and words of the naive Bayes blocks, that are looked up in a task.
WORDS = 50_000
#: Columns up to which the shared columns are kept as dense rows in a task.
NARROW = 2048

#: Views whose bits share a number.
BITS = 62

_PARTS = {"y": np.int32, "fold": np.int32, "starts": np.int32, "columns": np.int32, "vals": np.float64, "id": np.int64,
          "lengths": np.int32, "words": np.int32, "rares": np.int32, "counts": np.int32}
_SCHEMA = ", ".join(f"{c} binary" for c in _PARTS)


@dataclass
class Stored:
    """Some rows: sparse columns that all views share (missing numbers are no number), and the words of each answer.

    ``lengths`` (row, question): words; ``rares`` (row, question): words whose counts (fold x class) come with the row.
    """

    y: np.ndarray
    fold: np.ndarray
    starts: np.ndarray
    columns: np.ndarray
    vals: np.ndarray
    id: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    rares: np.ndarray
    counts: np.ndarray

    def part(self, a: int, b: int) -> "Stored":
        s, e = self.starts[a], self.starts[b]
        w, r = (np.concatenate(([0], np.cumsum(x.sum(axis=1)))) for x in (self.lengths, self.rares))
        return Stored(self.y[a:b], self.fold[a:b], self.starts[a:b + 1] - s, self.columns[s:e], self.vals[s:e], self.id[a:b],
                      self.lengths[a:b], self.words[w[a]:w[b]], self.rares[a:b], self.counts[r[a]:r[b]])

    def parts(self) -> Iterator["Stored"]:
        """Pieces of one fold whose dense rows are bounded."""
        n = len(self.y)
        rows, each = max(1, n), len(self.columns) / max(1, n)
        while rows > 1 and rows * min(rows * each, float(self.columns.max(initial=0) + 1)) > sb.DENSE:
            rows //= 2
        ends = [*(np.flatnonzero(np.diff(self.fold)) + 1), n]
        for a, b in zip([0, *ends], ends):
            for at in range(a, b, rows):
                yield self.part(at, min(at + rows, b))


@dataclass
class Encoder:
    """What a task needs to make the rows of every view.

    ``mask``: views (bits) that know a column; ``counts`` (word, fold x class)
    and ``question`` of the looked-up words; ``base`` {folds left out: (question, prior, class)};
    ``prior`` (view, question): the chosen one; ``weights`` {(view, fold): per
    multi-select question (columns, weights, intercepts)}.
    """

    views: list[frozenset[int]]
    folds: int
    k: int
    width: int
    raw_width: int
    mask: np.ndarray
    impute: dict[int, dict[int, float]]
    questions: list[str] = field(default_factory=list)
    at: list[int] = field(default_factory=list)
    priors: list[tuple[float, float]] = field(default_factory=list)
    counts: np.ndarray | None = None
    question: np.ndarray | None = None
    sizes: np.ndarray | None = None
    base: dict = field(default_factory=dict)
    prior: np.ndarray | None = None
    weights: dict = field(default_factory=dict)
    bits: int = field(default_factory=lambda: BITS)

    def left(self, v: int, fold: int) -> frozenset[int]:
        return self.views[v] if fold == NO_FOLD else self.views[v] | {fold}

    def inside(self, counts: np.ndarray, left: frozenset[int]) -> np.ndarray:
        """(word, class): counts over the folds that a model learns from."""
        by_fold = counts.reshape(len(counts), self.folds, self.k)
        return by_fold[:, [f for f in range(self.folds) if f not in left]].sum(axis=1)

    def logs(self, counts: np.ndarray, left: frozenset[int], priors: Sequence[tuple[float, float]]) -> tuple[np.ndarray, np.ndarray]:
        """(word, prior, class): logarithms of theta and of 1 - theta; words that the model never saw count for nothing."""
        n = self.inside(counts, left).astype(float)
        rows = self.sizes[[f for f in range(self.folds) if f not in left]].sum(axis=0).astype(float)
        a, b = np.array(priors).T
        theta = (n[:, None] + a[None, :, None]) / (rows[None, None] + (a + b)[None, :, None])
        seen = (n.sum(axis=1) > 0)[:, None, None]
        return np.where(seen, np.log(theta), 0.0), np.where(seen, np.log1p(-theta), 0.0)

    def odds(self, counts: np.ndarray, question: np.ndarray, v: int, fold: int, every: bool) -> np.ndarray:
        """(word, prior, class) log odds under all priors, or under the one chosen for the word's question."""
        yes, no = self.logs(counts, self.left(v, fold), self.priors)
        return yes - no if every else (yes - no)[np.arange(len(counts)), self.prior[v][question]][:, None]

    def log_prior(self, left: frozenset[int], a_class: float = 1.0) -> np.ndarray:
        n = self.sizes[[f for f in range(self.folds) if f not in left]].sum(axis=0)
        return np.log((n + a_class) / (n.sum() + self.k * a_class))

    def posteriors(self, rows: Stored, v: int, every: bool, held: dict) -> np.ndarray:
        """(row, question, prior, class) of rows of one fold."""
        fold, q = int(rows.fold[0]), len(self.questions)
        key = (v, fold, every)
        if key not in held:
            held[key] = self.odds(self.counts, self.question, v, fold, every)
        table = held[key]
        out = _segments(table.reshape(len(table), table.shape[1] * self.k)[rows.words], rows.lengths.ravel())
        if len(rows.counts):
            of = np.repeat(np.tile(np.arange(q), len(rows.y)), rows.rares.ravel())
            rare = self.odds(rows.counts, of, v, fold, every)
            out += _segments(rare.reshape(len(rare), -1), rows.rares.ravel())
        out = out.reshape(len(rows.y), q, -1, self.k)
        left = self.left(v, fold)
        base = self.base[left] if every else self.base[left][np.arange(q), self.prior[v]][:, None]
        out += base[None] + self.log_prior(left)
        out -= out.max(axis=3, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=3, keepdims=True)
        return out

    def shared(self, rows: Stored) -> tuple[np.ndarray, np.ndarray]:
        """(columns, rows over these), numbers that are missing as no number."""
        columns, at = (np.arange(self.raw_width), rows.columns) if self.raw_width <= NARROW else np.unique(rows.columns, return_inverse=True)
        x = np.zeros((len(rows.y), len(columns)))
        x[np.repeat(np.arange(len(rows.y)), np.diff(rows.starts)), at] = rows.vals
        return columns, x

    def under(self, rows: Stored, shared: tuple[np.ndarray, np.ndarray], v: int, held: dict) -> tuple[np.ndarray, np.ndarray]:
        """(columns, rows of one fold over these) under a view."""
        columns, x = shared
        known = (self.mask[columns, v // self.bits] >> (v % self.bits)) & 1 == 1
        x = x * known
        for j, value in self.impute[v].items():
            at = np.searchsorted(columns, j)
            if at < len(columns) and columns[at] == j:
                x[:, at] = np.where(np.isnan(x[:, at]), value, x[:, at])
        parts, names = [x], [columns]
        if self.prior is not None:
            p = self.posteriors(rows, v, False, held)[:, :, 0]
            parts.append(p.reshape(len(x), -1))
            names.append((np.array(self.at)[:, None] + np.arange(self.k)).ravel())
        for start, (a, b, w, bias) in self.weights.get((v, int(rows.fold[0])), {}).items():
            z = x[:, np.searchsorted(columns, a):np.searchsorted(columns, b)] @ w[columns[(columns >= a) & (columns < b)] - a] + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(z / z.sum(axis=1, keepdims=True))
            names.append(np.arange(start, start + self.k))
        return np.concatenate(names), np.concatenate(parts, axis=1)

    def views_of(self, fold: int) -> list[tuple[int, int]]:
        """(view, fold code) of the rows of a fold."""
        return [(v, v * self.folds + fold if fold >= 0 else NO_FOLD) for v, out in enumerate(self.views) if fold >= 0 or not out]


def _segments(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``lengths`` of them at a time."""
    out = np.zeros((len(lengths), values.shape[1]))
    some = lengths > 0
    if some.any():
        starts = np.cumsum(lengths) - lengths
        out[some] = np.add.reduceat(values, starts[some], axis=0)
    return out


def read(batches: Iterator[pa.RecordBatch], questions: int, cells: int) -> Iterator[Stored]:
    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(len(_PARTS))]
        for row in zip(*columns):
            x = {c: np.frombuffer(v, kind) for (c, kind), v in zip(_PARTS.items(), row)}
            for c in ("lengths", "rares"):
                x[c] = x[c].reshape(len(x["y"]), questions)
            x["counts"] = x["counts"].reshape(-1, cells)
            yield Stored(**x)


def expanded(frame: DataFrame, encoder: Encoder) -> sb.Expanded:
    """The stored rows as blocks of every view; rows without a class are left out."""
    cast = frame.sparkSession.sparkContext.broadcast(encoder)  # WORDS words at most, and a number by column

    def expand(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[sb.Block]:
        e, held = cast.value, {}
        none = np.zeros(0, np.int64)
        for whole in read(batches, len(e.questions), e.folds * e.k):
            for rows in whole.parts():
                asked = [(v, code) for v, code in e.views_of(int(rows.fold[0])) if code + 1 < len(wanted) and wanted[code + 1]]
                shared = e.shared(rows) if asked else None
                known = rows.y >= 0
                for v, code in asked:
                    columns, x = e.under(rows, shared, v, held)
                    yield sb.Block(rows.y[known], np.full(int(known.sum()), code, np.int32), none, columns, none, x if known.all() else x[known])

    return sb.Expanded(frame, expand, len(encoder.views) * encoder.folds)


def entries(frame: DataFrame, encoder: Encoder, codes: Sequence[int] | None = None) -> DataFrame:
    """(view, id, y, fold, columns, vals) of the rows of some fold codes, or of all."""
    cast = frame.sparkSession.sparkContext.broadcast(encoder)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, held = cast.value, {}
        for whole in read(batches, len(e.questions), e.folds * e.k):
            for rows in whole.parts():
                asked = [(v, code) for v, code in e.views_of(int(rows.fold[0])) if codes is None or code in codes]
                shared = e.shared(rows) if asked else None
                for v, code in asked:
                    columns, x = e.under(rows, shared, v, held)
                    n, (row, at) = len(x), np.nonzero(x)
                    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32))
                    y = pa.array(rows.y, pa.int32(), mask=rows.y < 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, v, np.int32)), pa.array(rows.id), y, pa.array(np.full(n, code, np.int32)),
                         pa.ListArray.from_arrays(ends, pa.array(columns[at].astype(np.int64))), pa.ListArray.from_arrays(ends, pa.array(x[row, at]))],
                        ["view", "id", "y", "fold", "columns", "vals"])

    return frame.mapInArrow(make, "view int, id bigint, y int, fold int, columns array<bigint>, vals array<double>")


# --- stored rows ---------------------------------------------------------------------


def column_masks(features: FoldFeatures) -> tuple[np.ndarray, DataFrame]:
    """(views, as bits, that know each column; (question, token, feature) of the columns)."""
    views = range(len(features.views))
    mask = np.zeros((features.width, len(views) // BITS + 1), np.int64)
    for q in features.num_cols:
        mask[features.ranges[q][0]] = (1 << BITS) - 1
    named = stored(features.columns, "columns")
    if features.width > len(features.num_cols):
        known = features.vocab.groupBy("block", "question", "token").agg(F.array(*[
            F.sum(F.when(F.floor(F.col("view") / BITS) == w, F.expr(f"shiftleft(1L, view % {BITS})")).otherwise(0)) for w in range(mask.shape[1])]).alias("bits"))
        for r in known.join(named, ["block", "question", "token"]).select("feature", "bits").toLocalIterator():  # a number by column
            mask[r["feature"]] = r["bits"]
    return mask, named


def answer_columns(features: FoldFeatures, nb_cols: Sequence[str]) -> list:
    """Arrays of each question's numbers, options and words, each made once."""
    words = {q: F.array_distinct(tokens(F.col(q).cast("string"))) for q in {*features.text_cols, *nb_cols}}
    return [*[num_mean(F.col(q)).cast("double").alias(f"num_{q}") for q in features.num_cols],
            *[F.array_distinct(split_options(F.col(q))).alias(f"cate_{q}") for q in features.cate_cols],
            *[w.alias(f"text_{q}") for q, w in sorted(words.items())]]


def word_counts(made: DataFrame, questions: Sequence[str], folds: int, k: int) -> DataFrame:
    """(question int, token, c array, total): rows with a word by fold and class, over the rows with a fold and a class."""
    parts = F.array(*[F.struct(F.lit(i).alias("question"), F.col(f"text_{q}").alias("t")) for i, q in enumerate(questions)])
    trained = made.where((F.col("fold") >= 0) & (F.col("fold") < folds) & F.col("y").isNotNull())
    slots = (trained.select("y", "fold", F.explode(parts).alias("x")).select("y", "fold", "x.question", F.explode("x.t").alias("token"))
             .groupBy("question", "token", (F.col("fold") * k + F.col("y")).alias("slot")).agg(F.count(F.lit(1)).alias("n")))
    cells = F.array(*[F.sum(F.when(F.col("slot") == s, F.col("n")).otherwise(0)) for s in range(folds * k)])
    return stored(slots.groupBy("question", "token").agg(cells.alias("c"), F.sum("n").alias("total")), "counts")


def store_rows(made: DataFrame, features: FoldFeatures, named: DataFrame, nb_cols: Sequence[str], counts: DataFrame | None,
               frequent: pa.Table | None, folds: int, k: int) -> DataFrame:
    """``made`` (id, y, fold, num_*, cate_*, text_*) as blocks of ``Stored`` rows."""
    spark, cells = made.sparkSession, folds * k
    few = named.where(F.col("feature") < features.ranges_end(WORDS)) if features.width > WORDS else named
    looked: dict[str, tuple[pa.Array, np.ndarray]] = {}
    got = few.select("question", "token", "feature").toArrow() if features.width > len(features.num_cols) else None  # WORDS rows
    asked = [*features.cate_cols, *features.text_cols]
    for q in asked:
        mine = got.filter(pc.equal(got["question"], q)) if got is not None else None
        looked[q] = ((mine["token"].combine_chunks(), mine["feature"].to_numpy()) if mine is not None else (pa.array([], pa.string()), np.zeros(0, np.int64)))
    words: dict[str, tuple[pa.Array, np.ndarray]] = {}
    for i, q in enumerate(nb_cols):
        at = np.flatnonzero(frequent["question"].to_numpy() == i)
        words[q] = (frequent["token"].take(pa.array(at)).combine_chunks(), at)
    cast = spark.sparkContext.broadcast((looked, words))

    none = F.array().cast("array<bigint>")
    rare_columns, rare_words = none.alias("_columns"), F.array().cast("array<struct<question:int,c:array<bigint>>>").alias("_words")
    prefix = {**{q: f"cate_{q}" for q in features.cate_cols}, **{q: f"text_{q}" for q in features.text_cols}}
    if features.width > WORDS:
        parts = F.array(*[F.struct(F.lit(q).alias("question"), F.col(c).alias("t")) for q, c in prefix.items()])
        long = made.select("id", F.explode(parts).alias("x")).select("id", "x.question", F.explode("x.t").alias("token"))
        rest = named.where(F.col("feature") >= features.ranges_end(WORDS)).select("question", "token", "feature")
        per = long.join(rest.hint("merge"), ["question", "token"]).groupBy("id").agg(F.collect_list("feature").alias("_columns"))
        made = join_rows(made, per).withColumn("_columns", F.coalesce("_columns", none))
        rare_columns = F.col("_columns")
    if counts is not None and frequent.num_rows == WORDS:
        keys = spark.createDataFrame(frequent.select(["question", "token"]))  # WORDS rows
        rest = counts.join(F.broadcast(keys), ["question", "token"], "left_anti").select("question", "token", "c")
        parts = F.array(*[F.struct(F.lit(i).alias("question"), F.col(f"text_{q}").alias("t")) for i, q in enumerate(nb_cols)])
        long = made.select("id", F.explode(parts).alias("x")).select("id", "x.question", F.explode("x.t").alias("token"))
        per = long.join(rest.hint("merge"), ["question", "token"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("question", "c"))).alias("_words"))
        made = join_rows(made, per).withColumn("_words", F.coalesce("_words", F.array().cast("array<struct<question:int,c:array<bigint>>>")))
        rare_words = F.col("_words")

    nums = [(features.ranges[q][0], f"num_{q}") for q in features.num_cols]
    order = ["y", "fold", "id", *[c for _, c in nums], *[prefix[q] for q in asked], *[f"text_{q}" for q in nb_cols]]
    source = made.select(F.coalesce("y", F.lit(-1)).cast("int").alias("y"), F.coalesce("fold", F.lit(NO_FOLD)).cast("int").alias("fold"), F.col("id").cast("bigint"),
                         *[F.col(c).alias(f"_{i}") for i, c in enumerate(order[3:])], rare_columns, rare_words)

    def found(column: pa.Array, table: tuple[pa.Array, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, number) of the known entries of a list column."""
        size = column.value_lengths().to_numpy(zero_copy_only=False)
        at = pc.index_in(column.flatten(), value_set=table[0])
        hit = at.is_valid().to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(column)), size)[hit], table[1][at.drop_null().to_numpy(zero_copy_only=False)]

    def block(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        looked, words = cast.value
        n, q, at = len(b), len(nb_cols), 3
        rows, columns, vals = [], [], []
        for j, _ in nums:
            rows.append(np.arange(n))
            columns.append(np.full(n, j))
            vals.append(b.column(at).to_numpy(zero_copy_only=False).astype(float))  # null: no number
            at += 1
        for name in asked:
            r, c = found(b.column(at), looked[name])
            rows.append(r)
            columns.append(c)
            vals.append(np.ones(len(r)))
            at += 1
        cells_, of = [], []
        for i, name in enumerate(nb_cols):
            r, c = found(b.column(at), words[name])
            of.append(r * q + i)
            cells_.append(c)
            at += 1
        rare = b.column(at)
        rows.append(np.repeat(np.arange(n), rare.value_lengths().to_numpy(zero_copy_only=False)))
        columns.append(rare.flatten().to_numpy(zero_copy_only=False))
        vals.append(np.ones(len(columns[-1])))
        rows, columns, vals = map(np.concatenate, (rows, columns, vals))
        by = np.argsort(rows, kind="stable")
        of, cells_ = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (of, cells_))
        word_by = np.argsort(of, kind="stable")
        met = b.column(at + 1)
        row = np.repeat(np.arange(n), met.value_lengths().to_numpy(zero_copy_only=False))
        flat = met.flatten()
        return {"y": b.column(0).to_numpy(zero_copy_only=False), "fold": b.column(1).to_numpy(zero_copy_only=False), "id": b.column(2).to_numpy(zero_copy_only=False),
                "starts": np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))), "columns": columns[by], "vals": vals[by],
                "lengths": np.bincount(of, minlength=n * q), "words": cells_[word_by],
                "rares": np.bincount(row * q + flat.field("question").to_numpy(zero_copy_only=False), minlength=n * q) if q else np.zeros(0),
                "counts": flat.field("c").flatten().to_numpy(zero_copy_only=False)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of a fold lie together, so that a block concerns few problems
        for some in sb.whole_blocks(batches, 8 * sb.BLOCK_ROWS):
            some = some.take(pc.sort_indices(some.column(1)))
            for at in range(0, len(some), sb.BLOCK_ROWS):
                x = block(some.slice(at, sb.BLOCK_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array([x[c].astype(kind).tobytes()], pa.binary()) for c, kind in _PARTS.items()], [*_PARTS])

    folder = scratch(spark, "rows")
    source.mapInArrow(pack, _SCHEMA).write.option("maxRecordsPerFile", FILE_BLOCKS).option("compression", "zstd").parquet(folder)
    return spark.read.schema(_SCHEMA).parquet(folder)


#: Blocks of a file, as in ``softmax_batch``; fewer, so that every core has some.
FILE_BLOCKS = 8


def naive_bayes(encoder: Encoder, made: DataFrame, nb_cols: Sequence[str], starts: Sequence[int], priors: Sequence[tuple[float, float]],
                folds: int, k: int) -> tuple[DataFrame, pa.Table]:
    """Fills in the models of the words; (all counts, the most frequent words)."""
    counts = word_counts(made, nb_cols, folds, k)
    frequent = counts.orderBy(F.desc("total"), "question", "token").limit(WORDS).toArrow()  # WORDS rows
    sizes = np.zeros((folds, k))
    for r in made.where((F.col("fold") >= 0) & (F.col("fold") < folds) & F.col("y").isNotNull()).groupBy("fold", "y").count().collect():  # folds x classes
        sizes[r["fold"], r["y"]] = r["count"]
    encoder.questions, encoder.at, encoder.priors, encoder.sizes = [*nb_cols], [*starts], [*priors], sizes
    encoder.counts = np.array(frequent["c"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, folds * k).astype(np.int32)
    encoder.question = frequent["question"].to_numpy().astype(np.int32)
    lefts = sorted({encoder.left(v, f) for v in range(len(encoder.views)) for f in range(NO_FOLD, folds)}, key=sorted)

    def sums(c: np.ndarray, question: np.ndarray) -> np.ndarray:
        out = np.zeros((len(lefts), len(nb_cols), len(priors), k))
        for i, left in enumerate(lefts):
            no = encoder.logs(c, left, priors)[1]
            np.add.at(out[i], question, no)
        return out

    base = sums(encoder.counts, encoder.question)
    if frequent.num_rows == WORDS:
        keys = made.sparkSession.createDataFrame(frequent.select(["question", "token"]))
        rest = counts.join(F.broadcast(keys), ["question", "token"], "left_anti").select("question", "c")

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(base.shape)
            for b in batches:
                c = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, folds * k)
                out += sums(c, b.column(0).to_numpy(zero_copy_only=False))
            yield sb._chunks(out)

        base = base + sb._summed(rest.mapInArrow(each, "chunk int, w binary"), base.size).reshape(base.shape)
    encoder.base = {left: base[i] for i, left in enumerate(lefts)}
    return counts, frequent


def choose_priors(encoder: Encoder, frame: DataFrame) -> np.ndarray:
    """(view, question): the prior with the most rows right out of their fold, the first of equals; folds that a view leaves out don't count."""
    shape = (len(encoder.views), len(encoder.questions), len(encoder.priors))
    cast = frame.sparkSession.sparkContext.broadcast(encoder)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, held, right = cast.value, {}, np.zeros(shape)
        for whole in read(batches, len(e.questions), e.folds * e.k):
            for rows in whole.parts():
                fold = int(rows.fold[0])
                for v, out in enumerate(e.views):
                    if fold >= 0 and fold not in out:
                        right[v] += (e.posteriors(rows, v, True, held).argmax(axis=3) == rows.y[:, None, None]).sum(axis=0)
        yield sb._chunks(right)

    return sb._summed(frame.mapInArrow(count, "chunk int, w binary"), math.prod(shape)).reshape(shape).argmax(axis=2)
