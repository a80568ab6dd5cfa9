"""Scans, sinks and fitted-state persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one given table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, strip_names: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (never inferSchema in jobs);
    S2: names with leading/trailing blanks are stripped."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return trim_columns(df) if strip_names else df


def trim_columns(df: DataFrame) -> DataFrame:
    """``columns.str.strip()``."""
    return df.toDF(*[c.strip() for c in df.columns])


def feature_schema(id_col: str, label_col: str, features: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(id_col, T.LongType()), T.StructField(label_col, T.IntegerType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: overwrite, no index column."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_by_segment(df: DataFrame, path: str, segment_col: str = "cluster") -> None:
    """One directory per segment; readers filtering on the segment get
    partition pruning instead of a scan of every file. Rows are gathered by
    segment so each task writes few directories; AQE splits a large segment
    over several tasks."""
    df.hint("rebalance", F.col(segment_col)).write.mode("overwrite").partitionBy(segment_col).parquet(path)


def save_params(df: DataFrame, path: str) -> None:
    """Fitted state is a small DataFrame; one file is enough."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def positional_row(df: DataFrame, order_col: str, position: int) -> DataFrame:
    """The row at 1-based ``position`` in ``order_col`` order.

    A top-``position`` TakeOrderedAndProject (per-partition heaps, no global
    sort), then the last of those few rows."""
    head = df.orderBy(order_col).limit(position)
    w = Window.orderBy(F.col(order_col).desc())
    return head.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


# ---------------------------------------------------------------- S7 metrics log
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("kind", T.StringType()),  # param | metric | tag
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def append_metrics(df: DataFrame, path: str) -> None:
    df.select([f.name for f in METRIC_SCHEMA]).write.mode("append").parquet(path)


def metrics_wide(log: DataFrame) -> DataFrame:
    """One row per run, one column per metric key (pivot over a small log)."""
    return (
        log.filter(F.col("kind") == "metric")
        .groupBy("run_id", "model")
        .pivot("key")
        .agg(F.first(F.col("value").cast("double")))
    )
