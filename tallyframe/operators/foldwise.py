"""Parameters of many training sets from one pass over the folds.

Rows carry a fold; rows of fold -1 are never learned from.  A view is a
training set, given by the folds that are left out of it.  Counts are kept by
fold, so the counts of every view are the total without its folds, and every
parameter table (imputed values, options, words, idf, layout, naive Bayes
counts) has the view as a key: k training sets cost one pass over the text and
one join, not k of each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import STOP_WORDS, num_mean, tokens
from tallyframe.operators import nb
from tallyframe.operators.categories import option_long
from tallyframe.operators.joins import join_parameters
from tallyframe.operators.ordering import positions

NO_FOLD = -1

#: Folds left out, by view.
Views = Sequence[frozenset[int]]


def by_fold(fold: Column, folds: int, weight: Column | None = None) -> Column:
    """The sum of ``weight`` (default: rows) in each fold, as one array aggregate."""
    w = F.lit(1) if weight is None else weight
    return F.array(*[F.sum(F.when(fold == f, w).otherwise(0)).cast("bigint") for f in range(folds)])


def without(counts: Column, folds: int, left_out: frozenset[int]) -> Column:
    """The sum of an array of counts by fold over the folds of a view."""
    total = F.lit(0).cast("bigint")
    for f in range(folds):
        if f not in left_out:
            total = total + F.get(counts, f)
    return total


# --- features -------------------------------------------------------------------


@dataclass
class FoldFeatures:
    """Feature parameters of every view, and one index of the columns of all views.

    ``impute`` (view, question, impute_value), ``vocab`` (view, block,
    question, token, idx, idf; idx as in a fit of the view alone), ``columns``
    (block, question, token, feature) for the union of the views.
    """

    num_cols: list[str]
    cate_cols: list[str]
    text_cols: list[str]
    text_method: str
    views: list[frozenset[int]]
    impute: dict[tuple[int, str], float]
    vocab: DataFrame
    columns: DataFrame
    ranges: dict[str, tuple[int, int]]
    width: int

    def ranges_end(self, columns: int) -> int:
        """The first feature number beyond the numbers and the first ``columns`` of the others."""
        return len(self.num_cols) + columns

    def layout(self) -> DataFrame:
        """T13 for every view: (view, block, question, token, feature), numbered as a fit of the view alone would."""
        spark = self.vocab.sparkSession
        sizes = {(r["view"], r["question"]): r["n"] for r in self.vocab.groupBy("view", "question").agg(F.count("*").alias("n")).collect()}
        offsets, nums = [], []
        for v in range(len(self.views)):
            nums += [(v, "num", q, None, i) for i, q in enumerate(self.num_cols)]
            at = len(self.num_cols)
            for q in self.cate_cols + self.text_cols:
                offsets.append((v, q, at))
                at += sizes.get((v, q), 0)
        first = spark.createDataFrame(nums, "view int, block string, question string, token string, feature bigint")
        starts = spark.createDataFrame(offsets, "view int, question string, at bigint")  # views x questions rows
        rest = self.vocab.join(F.broadcast(starts), ["view", "question"]).select("view", "block", "question", "token", (F.col("at") + F.col("idx")).alias("feature"))
        return first.unionByName(rest)

    def transform(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """T11 for every view: (view, id, feature, value) in the union's columns."""
        spark = df.sparkSession
        parts = []
        if self.num_cols:
            filled = [F.struct(F.lit(v).alias("view"), F.lit(self.ranges[q][0]).cast("bigint").alias("feature"),
                               F.coalesce(num_mean(F.col(q)), F.lit(self.impute[v, q])).alias("value"))
                      for v in range(len(self.views)) for q in self.num_cols]
            parts.append(df.select(F.col(id_col).alias("id"), F.explode(F.array(*filled)).alias("s")).select("s.view", "id", "s.feature", "s.value"))
        known = self.vocab.join(self.columns, ["block", "question", "token"]).select("view", "block", "question", "token", "feature", "idf")
        most = self.width * len(self.views)  # a view knows at most all columns
        if self.cate_cols:
            opts = option_long(df, self.cate_cols, id_col).withColumnRenamed("option", "token")
            parts.append(join_parameters(opts, known.where("block = 'cate'"), ["question", "token"], most).select("view", "id", "feature", F.lit(1.0).alias("value")))
        if self.text_cols:
            words = known.where("block = 'text'")
            if self.text_method == "binary":
                hit = _answers(df, self.text_cols, id_col).select("id", "question", F.explode(F.array_distinct("words")).alias("token"))
                parts.append(join_parameters(hit, words, ["question", "token"], most).select("view", "id", "feature", F.lit(1.0).alias("value")))
            else:
                each = _answers(df, self.text_cols, id_col).select("id", "question", F.size("words").alias("n_words"), F.explode("words").alias("token"))
                hit = join_parameters(each.groupBy("id", "question", "token", "n_words").agg(F.count("*").alias("tc")), words, ["question", "token"], most)
                parts.append(hit.select("view", "id", "feature", (F.col("tc") / F.col("n_words") * F.col("idf")).alias("value")))
        if not parts:
            return spark.createDataFrame([], "view int, id bigint, feature bigint, value double")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _answers(df: DataFrame, cols: Sequence[str], id_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """(id, *keep, question, words): the words of each answer."""
    parts = F.array(*[F.struct(F.lit(c).alias("question"), tokens(F.col(c).cast("string")).alias("words")) for c in cols])
    return df.select(F.col(id_col).alias("id"), *keep, F.explode(parts).alias("a")).select("id", *keep, "a.question", "a.words")


def fit_features(df: DataFrame, views: Views, folds: int, num_cols: Sequence[str] = (), cate_cols: Sequence[str] = (),
                 text_cols: Sequence[str] = (), text_method: str = "binary", stop_words: Sequence[str] = tuple(STOP_WORDS),
                 min_count: int = 2, impute_default: float = 1.0, id_col: str = "id", fold_col: str = "fold") -> FoldFeatures:
    """T12 for every view at once; ``df`` has the folds 0..folds-1 or ``NO_FOLD`` in ``fold_col``."""
    if text_method not in ("binary", "tfidf"):
        raise ValueError("text_method must be 'binary' or 'tfidf'")
    spark, fold = df.sparkSession, F.col(fold_col)
    views = [frozenset(v) for v in views]
    trained = df.where((fold >= 0) & (fold < folds))

    impute = {}
    rows = [0] * folds
    if num_cols or text_method == "tfidf":
        aggregates = [F.count("*").alias("n")] + [f(num_mean(F.col(q))).alias(f"{p}_{q}") for q in num_cols for p, f in (("s", F.sum), ("c", F.count))]
        got = {r[fold_col]: r for r in trained.groupBy(fold_col).agg(*aggregates).collect()}  # a row a fold
        rows = [got[f]["n"] if f in got else 0 for f in range(folds)]
        for v, out in enumerate(views):
            for q in num_cols:
                inside = [got[f] for f in got if f not in out]
                n, s = sum(r[f"c_{q}"] for r in inside), math.fsum(r[f"s_{q}"] or 0.0 for r in inside)
                impute[v, q] = s / n if n else float(impute_default)

    counted = []
    if cate_cols:
        options = option_long(trained, cate_cols, id_col, keep=[fold_col])
        counted.append(options.groupBy("question", F.col("option").alias("token")).agg(by_fold(fold, folds).alias("c"))
                       .select(F.lit("cate").alias("block"), "question", "token", "c", F.col("c").alias("d"), F.lit(1).alias("least")))
    if text_cols:
        pair = lambda words, c, d: F.transform(words, lambda t: F.struct(t.alias("token"), F.lit(c).alias("c"), F.lit(d).alias("d")))
        both = F.concat(pair(F.col("words"), 1, 0), pair(F.array_distinct("words"), 0, 1))
        seen = _answers(trained, text_cols, id_col, [fold_col]).select(fold_col, "question", F.explode(both).alias("t")).select(fold_col, "question", "t.*")
        if stop_words:
            seen = seen.where(~F.col("token").isin([*stop_words]))
        counted.append(seen.groupBy("question", "token").agg(by_fold(fold, folds, F.col("c")).alias("c_"), by_fold(fold, folds, F.col("d")).alias("d_"))
                       .select(F.lit("text").alias("block"), "question", "token", F.col("c_").alias("c"), F.col("d_").alias("d"), F.lit(min_count).alias("least")))
    schema = "view int, block string, question string, token string, idx bigint, idf double"
    if not counted:
        vocab, union = spark.createDataFrame([], schema), spark.createDataFrame([], "block string, question string, token string, feature bigint")
        sizes: dict = {}
    else:
        every = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])
        each = [F.struct(F.lit(v).alias("view"), without(F.col("c"), folds, out).alias("n"), without(F.col("d"), folds, out).alias("df"),
                         F.lit(float(sum(rows[f] for f in range(folds) if f not in out))).alias("rows")) for v, out in enumerate(views)]
        kept = (every.select("block", "question", "token", "least", F.explode(F.array(*each)).alias("x"))
                .where((F.col("x.n") >= F.col("least")) & (F.col("x.n") > 0)))
        idf = (F.when(F.col("block") == "text", F.ln(F.col("x.rows") / (1 + F.col("x.df")))) if text_method == "tfidf" else F.lit(None).cast("double"))
        vocab = positions(kept.select(F.col("x.view").alias("view"), "block", "question", "token", idf.alias("idf")),
                          ["token"], ["view", "block", "question"], name="idx")
        vocab = vocab.select("view", "block", "question", "token", "idx", "idf").checkpoint()
        union = positions(vocab.select("block", "question", "token").distinct(), ["token"], ["block", "question"], name="idx").checkpoint()
        sizes = {r["question"]: r["n"] for r in union.groupBy("question").agg(F.count("*").alias("n")).collect()}
    ranges, at = {}, 0
    for q in num_cols:
        ranges[q] = (at, at + 1)
        at += 1
    for q in [*cate_cols, *text_cols]:
        ranges[q] = (at, at + sizes.get(q, 0))
        at += sizes.get(q, 0)
    if counted:
        starts = spark.createDataFrame([(q, ranges[q][0]) for q in [*cate_cols, *text_cols]], "question string, at bigint")  # a row a question
        union = union.join(F.broadcast(starts), "question").select("block", "question", "token", (F.col("at") + F.col("idx")).alias("feature"))
    return FoldFeatures([*num_cols], [*cate_cols], [*text_cols], text_method, views, impute, vocab, union, ranges, at)


# --- cross-fitted naive Bayes -----------------------------------------------------


def crossfit_nb(present: DataFrame, rows: DataFrame, k: int, folds: int, views: Views = (frozenset(),),
                candidates: Sequence[tuple[float, float]] = ((1.0, 3.0),), a_class: float = 1.0, group: str = "question") -> DataFrame:
    """(view, id, fold, y, group, cand, prob array[K]): class probabilities from counts without the row's own fold.

    ``present``: distinct (id, y, fold, group, token), token null for rows
    without words; ``rows``: (id, y, fold).  A row of fold f meets, under a
    view, the model of all folds but f and the view's own; rows of fold -1 meet
    the whole view.  ``candidates``: pairs (a, b) of the Beta prior.
    """
    spark = present.sparkSession
    views = [frozenset(v) for v in views]
    models: dict[frozenset[int], int] = {}
    assigned = []
    for v, out in enumerate(views):
        for f in range(NO_FOLD, folds):
            left = out if f == NO_FOLD else out | {f}
            assigned.append((f, v, models.setdefault(left, len(models))))
    assign = spark.createDataFrame(assigned, "fold int, view int, model int")  # folds x views rows

    counts = {(r[0], r[1]): r[2] for r in rows.where("y is not null and fold >= 0").groupBy("fold", "y").count().collect()}  # folds x classes
    facts = []
    for left, m in models.items():
        n = [sum(counts.get((f, i), 0) for f in range(folds) if f not in left) for i in range(k)]
        facts.append((m, [float(x) for x in n], [math.log((x + a_class) / (sum(n) + k * a_class)) for x in n]))
    facts_table = spark.createDataFrame(facts, "model int, n array<double>, log_prior array<double>")  # a row a model

    cells = [(f, i) for f in range(folds) for i in range(k)]
    counted = (present.where("token is not null and fold >= 0 and y is not null").groupBy(group, "token")
               .agg(F.array(*[F.sum(F.when((F.col("fold") == f) & (F.col("y") == i), 1).otherwise(0)).cast("bigint") for f, i in cells]).alias("c")))
    training = []
    for left, m in models.items():
        sums = [sum((F.get("c", f * k + i) for f in range(folds) if f not in left), F.lit(0).cast("bigint")) for i in range(k)]
        training.append(F.struct(F.lit(m).alias("model"), *[s.alias(f"n{i}") for i, s in enumerate(sums)]))
    table = counted.select(group, "token", F.explode(F.array(*training)).alias("t")).select(group, "token", "t.*")
    table = table.where(sum((F.col(f"n{i}") for i in range(k)), F.lit(0)) > 0).join(F.broadcast(facts_table.select("model", "n")), "model")
    columns = [(c, i, a, b) for c, (a, b) in enumerate(candidates) for i in range(k)]
    theta = {(c, i): (F.col(f"n{i}") + F.lit(float(a))) / (F.get("n", i) + F.lit(float(a + b))) for c, i, a, b in columns}
    table = table.select(group, "token", "model", *[(F.ln(t) - F.log1p(-t)).alias(f"lo{c}_{i}") for (c, i), t in theta.items()],
                         *[F.log1p(-t).alias(f"no{c}_{i}") for (c, i), t in theta.items()]).checkpoint()
    base = table.groupBy(group, "model").agg(*[F.sum(f"no{c}_{i}").alias(f"b{c}_{i}") for c, i in theta])  # groups x models rows

    met = present.join(F.broadcast(assign), "fold")
    odds = table.select(group, "token", "model", *[f"lo{c}_{i}" for c, i in theta])
    # a value is 8 bytes, and 16 columns fill what a broadcast may hold
    size = table.count() * -(-len(theta) // 16)
    summed = (join_parameters(met, odds, [group, "token", "model"], size, "left").groupBy("view", "id", "fold", "y", group, "model")
              .agg(*[F.sum(F.coalesce(f"lo{c}_{i}", F.lit(0.0))).alias(f"s{c}_{i}") for c, i in theta]))
    scored = summed.join(base, [group, "model"], "left").join(F.broadcast(facts_table.select("model", "log_prior")), "model")
    each = [F.struct(F.lit(c).alias("cand"), nb.softmax(F.array(*[
        F.get("log_prior", i) + F.coalesce(f"b{c}_{i}", F.lit(0.0)) + F.col(f"s{c}_{i}") for i in range(k)])).alias("prob")) for c in range(len(candidates))]
    return scored.select("view", "id", "fold", "y", group, F.explode(F.array(*each)).alias("x")).select("view", "id", "fold", "y", group, "x.cand", "x.prob")


def choose_prior(scored: DataFrame, views: Views, group: str = "question") -> DataFrame:
    """The rows of ``crossfit_nb`` of the best candidate of each view and group.

    The best has the most rows right out of their fold, the first of equals;
    rows of the folds that a view leaves out don't count.
    """
    outside = [(v, f) for v, out in enumerate(views) for f in out]
    inside = F.col("fold") >= 0
    for v, f in outside:
        inside = inside & ~((F.col("view") == v) & (F.col("fold") == f))
    right = F.sum((inside & (nb.argmax("prob") == F.col("y"))).cast("bigint"))
    counted = scored.groupBy("view", group, "cand").agg(right.alias("right"))
    best = counted.groupBy("view", group).agg(F.max(F.struct("right", (-F.col("cand")).alias("c"))).alias("m"))
    chosen = best.select("view", group, (-F.col("m.c")).alias("cand"))  # views x groups rows
    return scored.join(F.broadcast(chosen), ["view", group, "cand"])
