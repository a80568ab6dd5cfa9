"""Stand-in feature tables derived from the given TPC-H-ish parquet tables.

The reference reads one wide table of numeric ratios with an id and a rare
binary label. These builders derive tables of the same shape from the given
data so that every job grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segscore.sources.tables import read_table

CUSTOMER_FEATURES = [
    "n_lines", "n_orders", "qty", "gross", "net",
    "avg_disc", "avg_tax", "max_line", "ret_rate", "sd_qty",
]


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders: ``customer ⋈ orders ⋈ lineitem``.

    Plan: lineitem is first reduced to one row per order (partial aggregate,
    output hash-partitioned on orderkey), so the join with ``orders`` moves
    one row per order instead of one per line and reuses that partitioning.
    The per-customer aggregate then merges the per-order partials exactly
    (sums, counts, max; the sample variance from n, Σq, Σq²).
    """
    li = read_table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("o_lines"),
        F.sum("l_quantity").alias("o_qty"),
        F.sum(F.col("l_quantity") * F.col("l_quantity")).alias("o_qty2"),
        F.sum("l_extendedprice").alias("o_gross"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("o_net"),
        # discount and tax carry two decimals: exact fixed-point sums, so the
        # averages are one correctly rounded division in any engine
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("o_disc"),
        F.sum(F.round(F.col("l_tax") * 100).cast("long")).alias("o_tax"),
        F.max("l_extendedprice").alias("o_max"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("o_ret"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    per_cust = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey")
        .agg(
            F.sum("o_lines").alias("n"),
            F.count(F.lit(1)).alias("n_ord"),
            F.sum("o_qty").alias("s_q"),
            F.sum("o_qty2").alias("s_q2"),
            F.sum("o_gross").alias("s_gross"),
            F.sum("o_net").alias("s_net"),
            F.sum("o_disc").alias("s_disc"),
            F.sum("o_tax").alias("s_tax"),
            F.max("o_max").alias("m_line"),
            F.sum("o_ret").alias("s_ret"),
        )
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    n = F.col("n").cast("double")
    var_samp = F.when(
        F.col("n") > 1,
        F.greatest(F.lit(0.0), (F.col("s_q2") - F.col("s_q") * F.col("s_q") / n) / (n - 1)),
    )
    return per_cust.join(cust, per_cust.o_custkey == cust.c_custkey).select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") < 0).cast("int").alias("label"),
        n.alias("n_lines"),
        F.col("n_ord").cast("double").alias("n_orders"),
        F.col("s_q").alias("qty"),
        F.col("s_gross").alias("gross"),
        F.col("s_net").alias("net"),
        (F.col("s_disc").cast("double") / (F.lit(100.0) * n)).alias("avg_disc"),
        (F.col("s_tax").cast("double") / (F.lit(100.0) * n)).alias("avg_tax"),
        F.col("m_line").alias("max_line"),
        (F.col("s_ret") / n).alias("ret_rate"),
        F.sqrt(var_samp).alias("sd_qty"),
    )


CUSTOMER_FEATURES_SQL = """
SELECT c.c_custkey AS id,
       CAST(c.c_acctbal < 0 AS INTEGER) AS label,
       CAST(count(*) AS DOUBLE) AS n_lines,
       CAST(count(DISTINCT o.o_orderkey) AS DOUBLE) AS n_orders,
       sum(l.l_quantity) AS qty,
       sum(l.l_extendedprice) AS gross,
       sum(l.l_extendedprice * (1 - l.l_discount)) AS net,
       CAST(sum(CAST(round(l.l_discount * 100) AS BIGINT)) AS DOUBLE) / (100.0 * count(*)) AS avg_disc,
       CAST(sum(CAST(round(l.l_tax * 100) AS BIGINT)) AS DOUBLE) / (100.0 * count(*)) AS avg_tax,
       max(l.l_extendedprice) AS max_line,
       avg(CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS ret_rate,
       stddev_samp(l.l_quantity) AS sd_qty
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey, c.c_acctbal
"""

EMBED_DIM = 64


def embedding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 float components → 64 double columns ``e0..e63`` plus the 0-9 label."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("int").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMBED_DIM)],
    )


# fixed character classes shared with the SQL twin
_PUNCT = "[.,;:!?]"
_DIGIT = "[0-9]"
_WORD = "[^ \t\n\r]+"
DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_punct", "upper_share"]


def doc_features(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """Whole-text counts per document, label = ``toxic``: the labelled
    documents, or all (label NULL where there is none)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    t = F.coalesce(F.col("text"), F.lit(""))
    length = F.length(t).cast("double")
    upper = (length - F.length(F.regexp_replace(t, "[A-Z]", ""))).cast("double")
    return d.join(lab, "doc_id", "inner" if labelled else "left").select(
        F.col("doc_id").alias("id"),
        F.col("toxic").cast("int").alias("label"),
        length.alias("n_chars"),
        F.regexp_count(t, F.lit(_WORD)).cast("double").alias("n_words"),
        (F.length(t) - F.length(F.regexp_replace(t, "\n", "")) + 1).cast("double").alias("n_lines"),
        (length - F.length(F.regexp_replace(t, _DIGIT, ""))).alias("n_digits"),
        (length - F.length(F.regexp_replace(t, _PUNCT, ""))).alias("n_punct"),
        F.when(length > 0, upper / length).otherwise(F.lit(0.0)).alias("upper_share"),
    )


DOC_FEATURES_SQL = f"""
SELECT d.doc_id AS id, CAST(l.toxic AS INTEGER) AS label,
  CAST(length(coalesce(d.text,'')) AS DOUBLE) AS n_chars,
  CAST(len(regexp_extract_all(coalesce(d.text,''), '{_WORD}')) AS DOUBLE) AS n_words,
  CAST(length(coalesce(d.text,'')) - length(replace(coalesce(d.text,''), chr(10), '')) + 1 AS DOUBLE) AS n_lines,
  CAST(length(coalesce(d.text,'')) - length(regexp_replace(coalesce(d.text,''), '{_DIGIT}', '', 'g')) AS DOUBLE) AS n_digits,
  CAST(length(coalesce(d.text,'')) - length(regexp_replace(coalesce(d.text,''), '{_PUNCT}', '', 'g')) AS DOUBLE) AS n_punct,
  CASE WHEN length(coalesce(d.text,'')) > 0 THEN
    CAST(length(coalesce(d.text,'')) - length(regexp_replace(coalesce(d.text,''), '[A-Z]', '', 'g')) AS DOUBLE)
    / length(coalesce(d.text,'')) ELSE 0.0 END AS upper_share
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
"""

ALL_DOC_FEATURES_SQL = DOC_FEATURES_SQL.replace("documents d JOIN", "documents d LEFT JOIN")

EVENT_FEATURES = ["value", "value_c", "log_value"]


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: the positive, right-skewed ``value`` (Box-Cox case),
    the same value centred on zero (Yeo-Johnson case), and its log; label =
    purchase events."""
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return e.select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        F.col("value"),
        (F.col("value") - 50.0).alias("value_c"),
        F.when(F.col("value") > 0, F.log(F.col("value"))).alias("log_value"),
    )


EVENT_VALUES_SQL = """
SELECT event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS label,
       value, value - 50.0 AS value_c, CASE WHEN value > 0 THEN ln(value) END AS log_value
FROM events
"""

def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a rare label and a coarse score full of ties:
    label = ``c_acctbal < 0``, score = ``round(-c_acctbal / 100)``, and a
    probability ``p = 1 / (1 + exp(-score / 10))`` for log-loss style metrics."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    score = F.round(-F.col("c_acctbal") / 100.0)
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") < 0).cast("int").alias("label"),
        score.alias("score"),
        (1.0 / (1.0 + F.exp(-score / 10.0))).alias("p"),
    )


SCORED_SQL = """
SELECT c_custkey AS id, c_mktsegment AS segment, CAST(c_acctbal < 0 AS INTEGER) AS label,
       round(-c_acctbal / 100.0) AS score,
       1.0 / (1.0 + exp(-round(-c_acctbal / 100.0) / 10.0)) AS p
FROM customer
"""
