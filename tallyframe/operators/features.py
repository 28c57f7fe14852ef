"""Feature generator (T11-T13, P11, S5): numbers + multi-select + text to
one sparse long table ``(id, feature, value)``.

Fitted state is a set of small-to-medium parameter tables, never Python
dicts of data:
  impute   (question, impute_value)                  one row per number question
  vocab    (block, question, token, idx, idf)        categories and words
  layout   (block, question, token, feature)         global column index
The global index follows the fixed layout: numbers, then one block per
multi-select question, then one block per text question; inside a block
options/words are in binary (code point) order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import STOP_WORDS, num_mean, tokens
from tallyframe.operators import clean
from tallyframe.operators.categories import option_long
from tallyframe.operators.joins import join_parameters
from tallyframe.operators.ordering import positions
from tallyframe.operators.text import words_with_count


def _stack_text(df: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    parts = F.array(*[F.struct(F.lit(c).alias("question"), F.col(c).cast("string").alias("text")) for c in cols])
    return df.select(F.col(id_col).alias("id"), F.explode(parts).alias("qt")).select("id", "qt.question", "qt.text")


def word_occurrences(df: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """(id, question, token, n_words): one row per word occurrence."""
    st = _stack_text(df, cols, id_col)
    return words_with_count(st, "id", "text", keep=["question"])


@dataclass
class FeatureModel:
    num_cols: list[str]
    cate_cols: list[str]
    text_cols: list[str]
    text_method: str
    impute: DataFrame
    vocab: DataFrame
    offsets: dict[str, int] = field(default_factory=dict)
    width: int = 0

    def layout(self) -> DataFrame:
        """(block, question, token, feature) for every output column."""
        spark = self.vocab.sparkSession
        nums = spark.createDataFrame([("num", q, None, self.offsets[q]) for q in self.num_cols],
                                     "block string, question string, token string, feature bigint")
        off = F.create_map(*[x for q in self.cate_cols + self.text_cols
                             for x in (F.lit(q), F.lit(self.offsets[q]))]) if (self.cate_cols or self.text_cols) else None
        if off is None:
            return nums
        v = self.vocab.select("block", "question", "token",
                              (F.element_at(off, F.col("question")) + F.col("idx")).cast("bigint").alias("feature"))
        return nums.unionByName(v)

    def transform(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """(id, feature, value) with the stored parameters."""
        spark = df.sparkSession
        parts = []
        if self.num_cols:
            filled = clean.impute_apply(df, self.impute, self.num_cols)
            st = F.explode(F.array(*[F.struct(F.lit(self.offsets[q]).cast("bigint").alias("feature"),
                                              F.col(q).cast("double").alias("value")) for q in self.num_cols]))
            parts.append(filled.select(F.col(id_col).alias("id"), st.alias("s")).select("id", "s.*"))
        lay = self.layout().where(F.col("block") != "num")
        if self.cate_cols:
            opts = option_long(df, self.cate_cols, id_col).withColumnRenamed("option", "token")
            hit = join_parameters(opts, lay.where(F.col("block") == "cate"), ["question", "token"], self.width)
            parts.append(hit.select("id", "feature", F.lit(1.0).alias("value")))
        if self.text_cols:
            lay_t = lay.where(F.col("block") == "text")
            if self.text_method == "binary":
                occ = _stack_text(df, self.text_cols, id_col).select(
                    "id", "question", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
                hit = join_parameters(occ, lay_t, ["question", "token"], self.width)
                parts.append(hit.select("id", "feature", F.lit(1.0).alias("value")))
            else:
                occ = (word_occurrences(df, self.text_cols, id_col)
                       .groupBy("id", "question", "token", "n_words").agg(F.count(F.lit(1)).alias("tc")))
                idf = self.vocab.where(F.col("block") == "text").select("question", "token", "idf")
                hit = join_parameters(join_parameters(occ, lay_t, ["question", "token"], self.width), idf, ["question", "token"], self.width)
                parts.append(hit.select("id", "feature", (F.col("tc") / F.col("n_words") * F.col("idf")).alias("value")))
        if not parts:
            return spark.createDataFrame([], "id bigint, feature bigint, value double")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # --- S5: save / load as parquet parameter tables ----------------------
    def save(self, path: str) -> None:
        spark = self.vocab.sparkSession
        meta = spark.createDataFrame(
            [(kind, q, self.offsets.get(q, -1)) for kind, cols in
             (("num", self.num_cols), ("cate", self.cate_cols), ("text", self.text_cols)) for q in cols]
            + [("text_method", self.text_method, self.width)],
            "kind string, question string, offset bigint")
        meta.write.mode("overwrite").parquet(f"{path}/meta")
        self.impute.write.mode("overwrite").parquet(f"{path}/impute")
        self.vocab.write.mode("overwrite").partitionBy("block").parquet(f"{path}/vocab")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        meta = spark.read.parquet(f"{path}/meta").collect()
        cols = {"num": [], "cate": [], "text": []}
        offsets, method, width = {}, "binary", 0
        for r in sorted(meta, key=lambda r: (r["offset"], r["question"])):
            if r["kind"] == "text_method":
                method, width = r["question"], int(r["offset"])
            else:
                cols[r["kind"]].append(r["question"])
                offsets[r["question"]] = int(r["offset"])
        vocab = spark.read.parquet(f"{path}/vocab").select("block", "question", "token", "idx", "idf")
        return FeatureModel(cols["num"], cols["cate"], cols["text"], method,
                            spark.read.parquet(f"{path}/impute"), vocab, offsets, width)


class FeatureGenerator:
    """Fit parameter tables on a training table."""

    def __init__(self, num_cols: Sequence[str] = (), cate_cols: Sequence[str] = (),
                 text_cols: Sequence[str] = (), text_method: str = "binary",
                 stop_words: Sequence[str] | None = tuple(STOP_WORDS), min_count: int = 2,
                 impute_default: float = 1.0):
        if text_method not in ("binary", "tfidf"):
            raise ValueError("text_method must be 'binary' or 'tfidf'")
        self.num_cols, self.cate_cols, self.text_cols = list(num_cols), list(cate_cols), list(text_cols)
        self.text_method, self.stop_words, self.min_count = text_method, list(stop_words or []), min_count
        self.impute_default = impute_default

    def fit(self, df: DataFrame, id_col: str = "id") -> FeatureModel:
        spark = df.sparkSession
        # one small aggregate; the values (one per number question) become a
        # literal parameter table so no later step re-runs the aggregate
        fitted = (clean.impute_fit(df, self.num_cols, num_mean, self.impute_default).collect()
                  if self.num_cols else [])
        impute = spark.createDataFrame([(r["question"], float(r["impute_value"])) for r in fitted],
                                       "question string, impute_value double")
        blocks = []
        if self.cate_cols:
            dom = option_long(df, self.cate_cols, id_col).select("question", F.col("option").alias("token")).distinct()
            blocks.append(dom.withColumn("block", F.lit("cate")).withColumn("idf", F.lit(None).cast("double")))
        if self.text_cols:
            occ = word_occurrences(df, self.text_cols, id_col)
            if self.stop_words:
                occ = occ.where(~F.col("token").isin(self.stop_words))
            voc = occ.groupBy("question", "token").agg(F.count(F.lit(1)).alias("cnt"))
            if self.min_count > 1:
                voc = voc.where(F.col("cnt") >= self.min_count)
            voc = voc.select("question", "token")
            if self.text_method == "tfidf":
                n_rows = df.count()
                present = (_stack_text(df, self.text_cols, id_col)
                           .select("id", "question", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token")))
                dfreq = (present.join(voc, ["question", "token"], "left_semi")
                         .groupBy("question", "token").agg(F.count(F.lit(1)).alias("df")))
                voc = (voc.join(dfreq, ["question", "token"], "left")
                       .withColumn("idf", F.ln(F.lit(float(n_rows)) / (1 + F.coalesce("df", F.lit(0)))))
                       .drop("df"))
            else:
                voc = voc.withColumn("idf", F.lit(None).cast("double"))
            blocks.append(voc.withColumn("block", F.lit("text")))
        if blocks:
            allv = blocks[0]
            for b in blocks[1:]:
                allv = allv.unionByName(b)
            vocab = positions(allv, ["token"], ["block", "question"], name="idx")
            # reused by sizes, layout and every transform: cut the lineage once
            vocab = vocab.select("block", "question", "token", "idx", "idf").checkpoint()
            sizes = {(r["block"], r["question"]): int(r["n"])
                     for r in vocab.groupBy("block", "question").agg(F.count(F.lit(1)).alias("n")).collect()}
        else:
            vocab = spark.createDataFrame([], "block string, question string, token string, idx bigint, idf double")
            sizes = {}
        offsets, pos = {}, 0
        for q in self.num_cols:
            offsets[q] = pos
            pos += 1
        for blk, cols in (("cate", self.cate_cols), ("text", self.text_cols)):
            for q in cols:
                offsets[q] = pos
                pos += sizes.get((blk, q), 0)
        return FeatureModel(self.num_cols, self.cate_cols, self.text_cols, self.text_method,
                            impute, vocab, offsets, pos)
