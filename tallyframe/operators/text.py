"""Text features over long tables.

Long forms:
  tokens      (id, token)             one row per word occurrence
  present     (id, token)             one row per distinct word of a row
  vocabulary  (token[, cnt][, idx])
  features    (id, token, value)
Work grows with the words present, never with rows x vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import STOP_WORDS, tokens, split_options
from tallyframe.operators.joins import join_parameters
from tallyframe.operators.ordering import positions


def token_table(df: DataFrame, id_col: str = "id", text_col: str = "text",
                keep: Sequence[str] = (), distinct: bool = False, outer: bool = False) -> DataFrame:
    """T1 + explode.  ``distinct`` dedupes inside the row (U5) before the
    explode, so no shuffle is needed for distinct (id, token) pairs.
    ``outer`` keeps rows without words (token NULL)."""
    arr = tokens(F.col(text_col))
    if distinct:
        arr = F.array_distinct(arr)
    out = df.select(F.col(id_col).alias("id"), *keep, F.explode_outer(arr).alias("token"))
    return out if outer else out.where(F.col("token").isNotNull())


#: Texts of a partition of ``by_id``: a task counts the words of that many.
TEXTS = 2_000


def by_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Texts dealt by id, on partitions that grow with their number: the words
    that are made of them lie by id and are counted without a shuffle."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.count() // TEXTS + 1), id_col)


def word_counts(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, token, cnt), the occurrences of each word of a row."""
    return token_table(by_id(df, id_col), id_col, text_col).groupBy("id", "token").agg(F.count(F.lit(1)).alias("cnt"))


def vocabulary(tok: DataFrame, stop_words: Sequence[str] | None = None, min_count: int = 1) -> DataFrame:
    """Distinct words; optional stop words (J8/U3) and a minimum
    **total** count (occurrences, not documents).  Output (token, cnt)."""
    t = tok.where(F.col("token").isNotNull())
    if stop_words:
        t = t.where(~F.col("token").isin(list(stop_words)))
    v = t.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    if min_count > 1:
        v = v.where(F.col("cnt") >= min_count)
    return v


def index_vocabulary(vocab: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """O1: 0-based index in binary (code point) order of the token."""
    return positions(vocab, ["token"], group_cols, name="idx")


def bow_binary(df: DataFrame, vocab: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, token, value=1) for each vocabulary word present in a row.
    The vocabulary join is an equi-join; AQE broadcasts it when its runtime
    size is under the broadcast threshold and shuffles otherwise."""
    present = token_table(df, id_col, text_col, distinct=True)
    return present.join(vocab.select("token"), "token", "left_semi").withColumn("value", F.lit(1))


def doc_freq(df: DataFrame, vocab: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Rows holding each vocabulary term (in-row distinct, then a
    count: one row per (id, token) so count == countDistinct(id))."""
    present = token_table(df, id_col, text_col, distinct=True)
    return (present.join(vocab.select("token"), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("df")))


def idf(df: DataFrame, vocab: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``ln(N / (1 + df))`` with N = all rows (missing text included).
    Terms of the vocabulary that never occur get df = 0."""
    n_rows = df.count()  # one scalar to the driver
    d = vocab.select("token").join(doc_freq(df, vocab, id_col, text_col), "token", "left")
    dfc = F.coalesce(F.col("df"), F.lit(0))
    return d.select("token", dfc.alias("df"), F.ln(F.lit(float(n_rows)) / (F.lit(1) + dfc)).alias("idf"))


def tfidf(df: DataFrame, idf_table: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``tf = count(word in row) / all words of the row`` (stop and
    unknown words count in the divisor) times idf; rows without words give
    no entries (all-zero row in dense form).  Output (id, token, value)."""
    occ = (words_with_count(df, id_col, text_col)
           .groupBy("id", "token", "n_words").agg(F.count(F.lit(1)).alias("tc")))
    return (occ.join(idf_table.select("token", "idf"), "token")
            .select("id", "token", (F.col("tc") / F.col("n_words") * F.col("idf")).alias("value")))


def words_with_count(df: DataFrame, id_col: str = "id", text_col: str = "text",
                     keep: Sequence[str] = ()) -> DataFrame:
    """(id, *keep, n_words, token): one row per word occurrence plus the word
    count of its row.  The token array is projected once before the explode
    (referenced twice, so Catalyst keeps it), instead of re-running the regex
    for every generated row."""
    arrs = df.select(F.col(id_col).alias("id"), *keep, tokens(F.col(text_col)).alias("_arr"))
    # explode_outer + a null filter: a plain explode makes Catalyst add a
    # ``size(array) > 0`` filter that would run the regex a second time
    ex = arrs.select("id", *keep, F.size("_arr").alias("n_words"), F.explode_outer("_arr").alias("token"))
    return ex.where(F.col("token").isNotNull())


def option_table(df: DataFrame, col: str, id_col: str = "id", keep: Sequence[str] = (),
                 sep: str = ",", distinct: bool = True) -> DataFrame:
    """C1/T5 building block: (id, option) for each stripped, non-empty option."""
    arr = split_options(F.col(col), sep)
    if distinct:
        arr = F.array_distinct(arr)
    return df.select(F.col(id_col).alias("id"), *keep, F.explode(arr).alias("option"))




def tfidf_fit_transform(df: DataFrame, stop_words: Sequence[str] | None = STOP_WORDS, min_count: int = 2,
                        id_col: str = "id", text_col: str = "text") -> DataFrame:
    """T3 + T8-T10 in one tokenisation pass: the per-row term counts
    ``(id, token, n_words, tc)`` feed the vocabulary (sum of tc = total
    count), the document frequency (rows per token) and the term
    frequencies; the table is persisted because all three read it.
    Output (id, token, value)."""
    n_rows = df.count()
    tc = (words_with_count(by_id(df.select(id_col, text_col), id_col), id_col, text_col)
          .groupBy("id", "token", "n_words").agg(F.count(F.lit(1)).alias("tc"))).persist()
    v = tc.groupBy("token").agg(F.sum("tc").alias("cnt"), F.count(F.lit(1)).alias("df"))
    if stop_words:
        v = v.where(~F.col("token").isin(list(stop_words)))
    if min_count > 1:
        v = v.where(F.col("cnt") >= min_count)
    # the size of the vocabulary tells how it meets the rows
    idf_t = v.select("token", F.ln(F.lit(float(n_rows)) / (1 + F.col("df"))).alias("idf")).persist()
    return join_parameters(tc, idf_t, ["token"], idf_t.count()).select("id", "token", (F.col("tc") / F.col("n_words") * F.col("idf")).alias("value"))


# --- mergeable sizes (T6, A2) ------------------------------------------------------

SKETCH_K = 14  # 2^14 registers: a standard error of about 0.7 %


def token_sketches(tok: DataFrame, keys: Sequence[str], lg_k: int = SKETCH_K) -> DataFrame:
    """(*keys, sketch): a HyperLogLog sketch of the tokens of each key, small enough to be stored and merged later.

    Keys without a token have an empty sketch.
    """
    return tok.groupBy(*keys).agg(F.hll_sketch_agg("token", F.lit(lg_k)).alias("sketch"))


def merged_sizes(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, approx_size): distinct tokens by merging stored sketches; the texts aren't read again."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_size"))
