"""Seeded, retry-stable splits.

Randomness comes from ``md5(id:seed)`` (equal in Spark and DuckDB, and the
same on every task retry), never from ``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators.ranking import global_running


def split_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", qcol(id_col).cast("string"), F.lit(str(seed))))


def hash_cut(fraction: float) -> str:
    """First 8 hex digits below this string ⇔ uniform < fraction."""
    return format(int(fraction * 2 ** 32), "08x")


def split_fast(df: DataFrame, test_size: float = 0.2, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Adds ``is_test``: a pure map-side filter, stratified in expectation."""
    h = F.substring(split_hash(id_col, seed), 1, 8)
    return df.withColumn("is_test", h < F.lit(hash_cut(test_size)))


def stratified_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, label: str = "label",
                     id_col: str = "id") -> DataFrame:
    """Adds ``is_test`` with exactly round(test_size · n_class) test rows per
    class (half to even): the rows with the smallest hashes in each class.
    Ranks come from a range-partitioned global sort, so a dominant class is
    spread over many tasks rather than one window partition."""
    keyed = df.withColumn("_h", split_hash(id_col, seed))
    r = global_running(keyed, [F.col("_h").asc(), qcol(id_col).asc()], partition_by=[label], rank_col="_r")
    n = df.groupBy(qcol(label).alias(label)).agg(F.count(F.lit(1)).alias("_n"))
    r = r.join(F.broadcast(n), label)  # one row per class
    return r.withColumn("is_test", F.col("_r") <= F.bround(F.lit(test_size) * F.col("_n"), 0)).drop("_h", "_r", "_n")


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = "label", id_col: str = "id") -> DataFrame:
    """``fold`` = (rank within class by hash − 1) mod k, so every
    class is dealt round-robin over the folds (sizes differ by ≤ 1)."""
    keyed = df.withColumn("_h", split_hash(id_col, seed))
    r = global_running(keyed, [F.col("_h").asc(), qcol(id_col).asc()], partition_by=[label], rank_col="_r")
    return r.withColumn("fold", ((F.col("_r") - 1) % k).cast("int")).drop("_h", "_r")
