"""Exact dedup by content sort [native].

Texts are equal when identical after every character of ``[\\x20\\x09-\\x0D]``
is deleted. Rows are range-partitioned by their normalised text at splitters
that Spark samples (leading characters, then the hash of the whole normalised
text, so a splitter is small however long a text is), sorted within each
partition by the whole normalised text (Spark's external sort), and equal
neighbours form a group: the window's group borders are full comparisons of
adjacent texts.

A group that holds more than ``1 / (4 * partitions)`` of all rows is dealt to
several ranges by a salt; its keeper and size come from a pre-aggregation
(map-side combined, full texts as keys) that covers only such groups. There
are at most ``4 * partitions`` of them, which bounds what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segscore.llm.common import BLANK, shuffle_partitions

#: Characters of the normalised text that lead the range key.
LEAD = 32
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK + "+", "")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``.

    Of equal texts the row with the most code points in the original text
    stays, then the smallest id (null ids last; ``keep_id`` is null where all
    are). Null counts as the empty text and equals blank texts. Rows that
    repeat entirely tie; one of them is ``kept``. Columns of ``df`` named like
    the four added ones are replaced. An empty table gives an empty result."""
    spark = df.sparkSession
    df = df.drop(*[c for c in ADDED if c != id_col and c != text_col])
    n = shuffle_partitions(spark)
    whole = F.xxhash64(normalised(F.col(text_col)))
    limit = max(64, df.count() // (4 * n))
    hot = df.select(whole.alias("_x_hash")).groupBy("_x_hash").agg(F.count(F.lit(1)).alias("_x_n"))
    hot = hot.filter(F.col("_x_n") > limit).collect()  # at most 4n rows: each holds over 1 / (4n) of all

    keyed = (df.withColumn("_x_norm", normalised(F.col(text_col)))
             .withColumn("_x_hash", F.xxhash64("_x_norm"))
             .withColumn("_x_lead", F.substring("_x_norm", 1, LEAD))
             .withColumn("_x_len", F.char_length(F.coalesce(F.col(text_col), F.lit("")))))
    if hot:
        salts = spark.createDataFrame([(r[0], -(-r[1] // limit)) for r in hot], "_x_hash long, _x_salts long")
        keyed = keyed.join(F.broadcast(salts), "_x_hash", "left")
        order = F.struct((-F.col("_x_len")).alias("l"), F.col(id_col).isNull().alias("o"), F.col(id_col).alias("i"))
        winner = (keyed.filter("_x_salts is not null").groupBy("_x_norm")
                  .agg(F.count(F.lit(1)).alias("_x_size"), F.min(order).alias("_x_best"))
                  .select(F.sha2("_x_norm", 256).alias("_x_sha"), "_x_size", "_x_best"))
        # one row per text whose hash is among the at most 4n hot ones
        winner = F.broadcast(winner)
        salt = F.coalesce(F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.col("_x_salts")), F.lit(0))
        keyed = keyed.withColumn("_x_salt", salt)
    keyed = keyed.drop("_x_norm")
    range_key = ["_x_lead", "_x_hash"] + (["_x_salt"] if hot else [])  # a constant column would hide the range's order
    # the normalised text is made anew after the exchange: only the original crosses it
    placed = keyed.repartitionByRange(n, *range_key).withColumn("_x_norm", normalised(F.col(text_col)))
    run = (Window.partitionBy(*range_key, "_x_norm")
           .orderBy(F.col("_x_len").desc(), F.col(id_col).asc_nulls_last()))
    every = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (placed.withColumn("_x_row", F.row_number().over(run))
           .withColumn("keep_id", F.first(id_col).over(every))
           .withColumn("group_size", F.count(F.lit(1)).over(every))
           .withColumn("kept", F.col("_x_row") == 1)
           .withColumn("text_sha256", F.sha2("_x_norm", 256)))
    if hot:
        salted = F.col("_x_salts").isNotNull() & F.col("_x_size").isNotNull()
        best = F.col("_x_best.i").eqNullSafe(F.col(id_col)) & (F.col("_x_best.l") == -F.col("_x_len"))
        out = (out.join(winner, F.col("text_sha256") == F.col("_x_sha"), "left")
               .withColumn("keep_id", F.when(salted, F.col("_x_best.i")).otherwise(F.col("keep_id")))
               .withColumn("group_size", F.when(salted, F.col("_x_size")).otherwise(F.col("group_size")))
               .withColumn("kept", F.when(salted, best & (F.col("_x_row") == 1)).otherwise(F.col("kept"))))
    return out.select(*df.columns, *ADDED)
