"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segscore.session import cut_lineage as checkpointed
from segscore.session import ensure_checkpoint_dir

#: The contracts' white space: space and the code points 9 to 13.
BLANK = r"[\x20\x09-\x0D]"
BLANK_CHARS = " \t\n\x0b\x0c\r"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder. The shuffle files of
    this one job are dropped when its result is stored, so a chain of steps
    holds one step's shuffle at a time."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return checkpointed(df.select("*"))  # a query of its own, made under the setting
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


class Scratch:
    """Tables of one run, written under the shared checkpoint folder; a step's
    table is dropped as soon as a later one holds what is needed of it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Writes ``df`` (its blobs are packed already), in folders by ``by``, and reads it back."""
        path = f"{self.folder}/{name}"
        conf = self.spark.conf
        before = conf.get(_CLEANUP, None)
        conf.set(_CLEANUP, "true")
        try:
            out = df.select("*").write.option("compression", "uncompressed")
            (out.partitionBy(by) if by else out).parquet(path)
        finally:
            if before is None:
                conf.unset(_CLEANUP)
            else:
                conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: What gives back the memory that operators keep in this worker process between their tasks.
_KEPT: list[Callable[[], None]] = []


def keep_until_released(give_back: Callable[[], None]) -> None:
    """An operator's task keeps memory for its next tasks; the first task of
    another operator that calls ``release`` runs ``give_back``."""
    _KEPT.append(give_back)


def release() -> None:
    """Worker processes outlive the operators of a pipeline: drops what an
    earlier one kept in this process and hands its pages back."""
    if not _KEPT:
        return
    while _KEPT:
        _KEPT.pop()()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_columns(df: DataFrame, **added: str) -> T.StructType:
    """The schema of ``df`` and further columns (name=type)."""
    return T.StructType([*df.schema.fields, *(T.StructField(c, T._parse_datatype_string(t)) for c, t in added.items())])


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; 0 for null and blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, BLANK + "+"))).cast("long")


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, empty for null."""
    if column.null_count:
        column = pc.fill_null(column, "")
    return column.cast(pa.large_binary()).to_pylist()


def text_slices(column: pa.Array, limit: int = 2 << 20, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of at most ``rows`` rows and about ``limit`` bytes: (first row, end row, their bytes,
    n + 1 offsets into them). Views of the Arrow buffers; a text longer than
    ``limit`` comes alone and whole."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def running(df: DataFrame, group: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in
    ``order`` inside its ``group`` (nulls form a group of their own).

    A range-partitioned sort splits a hot group over many tasks; the sorted
    rows are checkpointed, each (partition, group) is summed, and those sums
    (at most partitions + groups rows) become offsets by one window per group.
    Nothing but the sums meets by group."""
    n = shuffle_partitions(df.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in group]
    s = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    s = cut_lineage(s.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    total = s.groupBy(*group, "_part").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    total = total.toDF(*[f"_g_{c}" for c in group], "_p", "_before")
    within = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (s.join(total, same)
            .withColumn(out, F.col("_before") + F.col("_within"))
            .drop("_at", "_part", "_p", "_within", "_before", *[f"_g_{c}" for c in group]))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(node, root)`` for
    every node of an edge, ``root`` the smallest node of its component.

    Alternating large-star and small-star rounds, each a minimum by node
    (combined map-side) and a join that AQE may split on a hot node. Rounds
    grow with the logarithm of the longest chain. Every round is checkpointed;
    the driver sees two numbers a round."""
    e = (edges.filter("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = cut_lineage(e)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(small)
        mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
