"""Text feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import STOP_WORDS, md5_bucket, round6
from tallyframe.operators import text as tx
from tallyframe.operators.features import FeatureGenerator
from tallyframe.operators.split import head_rows
from tallyframe.plans.oracle_views import bucket_sql, n1_sql, options_sql, with_views, words_sql
from tallyframe.plans.registry import register
from tallyframe.sources import views
from tallyframe.sources.views import CATEGORY_QUESTIONS, TEXT_QUESTIONS

STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
OCC = ("occ", f"SELECT id, unnest({words_sql('text')}) AS token FROM docs")
PRES = ("pres", f"SELECT DISTINCT id, unnest({words_sql('text')}) AS token FROM docs")
VOC3 = ("voc", f"SELECT token, count(*) AS cnt FROM occ WHERE token NOT IN ({STOP_SQL}) GROUP BY token HAVING count(*) >= 2")


def _docs_sql(body, *ctes):
    return with_views(body, "docs", extra=list(ctes))


def _vocab3(d):
    return tx.vocabulary(tx.token_table(d), STOP_WORDS, min_count=2)


@register("tokens", _docs_sql("SELECT id, token, count(*) AS cnt FROM occ GROUP BY id, token", OCC))
def q_tokens(spark, sf_dir):
    """Words of every document, counted per (id, token)."""
    return tx.word_counts(views.docs(spark, sf_dir).select("id", "text"))


@register("vocab_all", _docs_sql("SELECT DISTINCT token FROM occ", OCC))
def q_vocab_all(spark, sf_dir):
    """Distinct words."""
    return tx.vocabulary(tx.token_table(views.docs(spark, sf_dir))).select("token")


@register("vocab_indexed", _docs_sql(
    "SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT token FROM occ)",
    OCC))
def q_vocab_indexed(spark, sf_dir):
    """O1: sorted vocabulary with index (range-partitioned, no single-task window)."""
    v = tx.vocabulary(tx.token_table(views.docs(spark, sf_dir))).select("token")
    return tx.index_vocabulary(v)


@register("vocab_stop_minfreq", _docs_sql("SELECT token, cnt FROM voc", OCC, VOC3))
def q_vocab_stop_minfreq(spark, sf_dir):
    """Stop words removed, total count >= 2."""
    return _vocab3(views.docs(spark, sf_dir))


@register("vocab_train_only", _docs_sql(
    """SELECT DISTINCT p.id, p.token FROM pres p
       WHERE p.token IN (SELECT token FROM pres WHERE id IN (SELECT id FROM head))""",
    PRES, ("head", "SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n "
                   "FROM docs) WHERE pos < floor(0.8 * n)")))
def q_vocab_train_only(spark, sf_dir):
    """Vocabulary from the first int(0.8 n) rows by id; every row encoded."""
    d = head_rows(views.docs(spark, sf_dir), 0.8)
    vocab = tx.vocabulary(tx.token_table(d.where("is_head"))).select("token")
    return tx.bow_binary(d, vocab).select("id", "token")


@register("vocab_size", with_views(" UNION ALL ".join(
    f"SELECT '{q}' AS question, count(DISTINCT t) AS vocab_size FROM (SELECT unnest({words_sql(q)}) AS t FROM survey)"
    for q in TEXT_QUESTIONS), "survey"))
def q_vocab_size(spark, sf_dir):
    """Vocabulary size by question."""
    s = views.survey(spark, sf_dir)
    parts = F.array(*[F.struct(F.lit(q).alias("question"), F.col(q).alias("text")) for q in TEXT_QUESTIONS])
    st = s.select(F.explode(parts).alias("qt")).select("qt.question", "qt.text")
    occ = tx.token_table(st.withColumn("id", F.lit(0)), keep=["question"])
    return (occ.select("question", "token").distinct().groupBy("question")
            .agg(F.count(F.lit(1)).alias("vocab_size")))


@register("bow_binary", _docs_sql("SELECT p.id, p.token, 1 AS value FROM pres p JOIN voc v ON p.token = v.token",
                                  OCC, PRES, VOC3))
def q_bow_binary(spark, sf_dir):
    """Binary bag of words over the T3 vocabulary."""
    d = views.docs(spark, sf_dir)
    return tx.bow_binary(d, _vocab3(d)).select("id", "token", "value")


@register("doc_freq", _docs_sql("SELECT p.token, count(*) AS df FROM pres p JOIN voc v ON p.token = v.token GROUP BY p.token",
                                OCC, PRES, VOC3))
def q_doc_freq(spark, sf_dir):
    """Rows holding each vocabulary word."""
    d = views.docs(spark, sf_dir)
    return tx.doc_freq(d, _vocab3(d))


IDF_CTE = ("idf", """SELECT v.token, coalesce(f.df, 0) AS df, ln((SELECT count(*) FROM docs) / (1 + coalesce(f.df, 0))) AS idf
                     FROM voc v LEFT JOIN (SELECT token, count(*) AS df FROM pres GROUP BY token) f ON v.token = f.token""")


@register("idf", _docs_sql("SELECT token, df, round(idf, 6) AS idf FROM idf", OCC, PRES, VOC3, IDF_CTE))
def q_idf(spark, sf_dir):
    """ln(N / (1 + df)), N = all rows."""
    d = views.docs(spark, sf_dir)
    return tx.idf(d, _vocab3(d)).select("token", "df", round6("idf").alias("idf"))


TF_CTE = ("tf", f"""SELECT id, token, count(*) AS tc, any_value(nw) AS nw FROM
                   (SELECT id, nw, unnest(w) AS token FROM
                     (SELECT id, w, len(w) AS nw FROM (SELECT id, {words_sql('text')} AS w FROM docs)))
                   GROUP BY id, token""")


@register("tfidf", _docs_sql("SELECT tf.id, tf.token, round(tf.tc / tf.nw * idf.idf, 6) AS value "
                             "FROM tf JOIN idf ON tf.token = idf.token", OCC, PRES, VOC3, IDF_CTE, TF_CTE))
def q_tfidf(spark, sf_dir):
    """Term frequency over all words of the row, times idf."""
    t = tx.tfidf_fit_transform(views.docs(spark, sf_dir), STOP_WORDS, 2)
    return t.select("id", "token", round6("value").alias("value"))


_TRAIN = f"{bucket_sql('id')} < 8000"
TRAIN_CTES = [
    ("tr", f"SELECT * FROM docs WHERE {_TRAIN}"),
    ("occ", f"SELECT id, unnest({words_sql('text')}) AS token FROM tr"),
    ("voc", f"SELECT token FROM occ WHERE token NOT IN ({STOP_SQL}) GROUP BY token HAVING count(*) >= 2"),
    ("pres", f"SELECT DISTINCT id, unnest({words_sql('text')}) AS token FROM tr"),
    ("idf", """SELECT v.token, ln((SELECT count(*) FROM tr) / (1 + coalesce(f.df, 0))) AS idf
               FROM voc v LEFT JOIN (SELECT token, count(*) AS df FROM pres GROUP BY token) f ON v.token = f.token"""),
    ("tf", f"""SELECT id, token, count(*) AS tc, any_value(nw) AS nw FROM
               (SELECT id, nw, unnest(w) AS token FROM
                 (SELECT id, w, len(w) AS nw FROM (SELECT id, {words_sql('text')} AS w FROM docs
                  WHERE NOT ({_TRAIN})))) GROUP BY id, token"""),
]


@register("transform_new_rows", _docs_sql("SELECT tf.id, tf.token, round(tf.tc / tf.nw * idf.idf, 6) AS value "
                                          "FROM tf JOIN idf ON tf.token = idf.token", *TRAIN_CTES))
def q_transform_new_rows(spark, sf_dir):
    """Vocabulary and idf fitted on the training split encode held-out rows."""
    d = views.docs(spark, sf_dir).withColumn("bucket", md5_bucket("id"))
    tr, te = d.where(F.col("bucket") < 8000), d.where(F.col("bucket") >= 8000)
    t = tx.tfidf(te, tx.idf(tr, _vocab3(tr)))
    return t.select("id", "token", round6("value").alias("value"))


# --- feature generator on the survey (T12, T13, P11) ----------------------

NUMS = ["complexity", "ingredients", "price"]
_QORDER = "SELECT * FROM (VALUES " + ", ".join(
    f"('{q}', {i})" for i, q in enumerate(CATEGORY_QUESTIONS + TEXT_QUESTIONS)) + ") t(question, ord)"
def feat_ctes(train: str = "true") -> list[tuple[str, str]]:
    """DuckDB text of the survey feature generator: parameters fitted on the
    rows where ``train`` holds, every row encoded."""
    return [
        ("fnums", " UNION ALL ".join(
            f"SELECT id, {i} AS feature, coalesce({n1_sql(q)}, (SELECT coalesce(avg({n1_sql(q)}), 1.0) FROM survey "
            f"WHERE {train})) AS value FROM survey" for i, q in enumerate(NUMS))),
        ("fopts", " UNION ALL ".join(
            f"SELECT DISTINCT id, '{q}' AS question, unnest({options_sql(q)}) AS token FROM survey"
            for q in CATEGORY_QUESTIONS)),
        ("fwords", " UNION ALL ".join(
            f"SELECT id, '{q}' AS question, unnest({words_sql(q)}) AS token FROM survey" for q in TEXT_QUESTIONS)),
        ("ftrain", f"SELECT id FROM survey WHERE {train}"),
        ("fcdom", "SELECT question, token, row_number() OVER (PARTITION BY question ORDER BY token) - 1 AS idx "
                  "FROM (SELECT DISTINCT question, token FROM fopts WHERE id IN (SELECT id FROM ftrain))"),
        ("ftdom", "SELECT question, token, row_number() OVER (PARTITION BY question ORDER BY token) - 1 AS idx FROM "
                  f"(SELECT question, token FROM fwords WHERE token NOT IN ({STOP_SQL}) AND id IN (SELECT id FROM ftrain) "
                  "GROUP BY question, token HAVING count(*) >= 2)"),
        ("fsizes", "SELECT question, count(*) AS n FROM (SELECT question FROM fcdom UNION ALL SELECT question FROM ftdom) "
                   "GROUP BY question"),
        ("qorder", _QORDER),
        ("foff", f"""SELECT q.question, 'cate' AS block, {len(NUMS)} + coalesce(sum(coalesce(s.n, 0)) OVER
                     (ORDER BY q.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
                     FROM qorder q LEFT JOIN fsizes s ON q.question = s.question"""),
        ("flayout", "SELECT 'num' AS block, question, NULL::VARCHAR AS token, CAST(ord AS BIGINT) AS feature FROM (VALUES "
                    + ", ".join(f"('{q}', {i})" for i, q in enumerate(NUMS)) + ") t(question, ord) "
                    "UNION ALL SELECT 'cate', d.question, d.token, CAST(o.off + d.idx AS BIGINT) FROM fcdom d "
                    "JOIN foff o ON d.question = o.question "
                    "UNION ALL SELECT 'text', d.question, d.token, CAST(o.off + d.idx AS BIGINT) FROM ftdom d "
                    "JOIN foff o ON d.question = o.question"),
        ("flong", """SELECT id, CAST(feature AS BIGINT) AS feature, value FROM fnums
                     UNION ALL SELECT o.id, l.feature, 1.0 FROM fopts o JOIN flayout l
                               ON l.block = 'cate' AND o.question = l.question AND o.token = l.token
                     UNION ALL SELECT w.id, l.feature, 1.0 FROM (SELECT DISTINCT id, question, token FROM fwords) w
                               JOIN flayout l ON l.block = 'text' AND w.question = l.question AND w.token = l.token"""),
    ]


_FEAT_CTES = feat_ctes()


def _survey_gen():
    return FeatureGenerator(NUMS, CATEGORY_QUESTIONS, TEXT_QUESTIONS, "binary")


@register("feature_layout", with_views("SELECT block, question, token, feature FROM flayout", "survey",
                                       extra=_FEAT_CTES))
def q_feature_layout(spark, sf_dir):
    """Global column index of every feature (numbers, categories, words)."""
    return _survey_gen().fit(views.survey(spark, sf_dir)).layout()


@register("feature_long", with_views("SELECT id, feature, round(value, 6) AS value FROM flong", "survey",
                                     extra=_FEAT_CTES))
def q_feature_long(spark, sf_dir):
    """The whole survey as one sparse (id, feature, value) table."""
    s = views.survey(spark, sf_dir).persist()  # read by the fit and by the encoder
    m = _survey_gen().fit(s)
    return m.transform(s).select("id", "feature", round6("value").alias("value"))
