"""The flow on the ratio table the recipes were written for: a CSV with an id
column, a 0/1 label and 95 ratios whose header names may carry blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segscore.functions.scalar import qcol
from segscore.plans import recipes as R
from segscore.plans import training
from segscore.sources.tables import feature_schema, read_csv_table


def read_ratios(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """``(id, label, ratios…)`` of the CSV at ``path``, read with an explicit
    schema. ``header`` gives the file's columns in order (default: id, label,
    then the ratios in their usual order). Without an id column the position in
    the file would be the id; such a file is refused."""
    names = header or [R.ID_COLUMN, R.LABEL_COLUMN, *R.FEATURE_LABELS]
    trimmed = [n.strip() for n in names]
    missing = [c for c in (R.ID_COLUMN, R.LABEL_COLUMN, *R.FEATURE_LABELS) if c not in trimmed]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    schema = feature_schema(R.ID_COLUMN, R.LABEL_COLUMN, R.FEATURE_LABELS)
    kinds = {f.name: f for f in schema.fields}
    fields = [T.StructField(n, kinds[t].dataType if t in kinds else T.StringType()) for n, t in zip(names, trimmed)]
    df = read_csv_table(spark, path, T.StructType(fields))
    return df.select(qcol(R.ID_COLUMN).cast("long").alias("id"), qcol(R.LABEL_COLUMN).cast("int").alias("label"),
                     *[qcol(f) for f in R.FEATURE_LABELS])


def fit_ratios(df: DataFrame, recipes: dict | None = None, search: tuple | None = R.CLASSIFIER_SEARCH) -> training.Trained:
    """The whole fit with the fixed drop lists, reduction bounds, seeds and recipes."""
    return training.fit_all(df, R.FEATURE_LABELS, recipes or R.reference_recipes(), k=R.N_SEGMENTS, kseed=R.KMEANS_SEED,
                            drops=R.GLOBAL_DROP, post_drop=R.POST_REDUCTION_DROP, classifier_search=search)


def column_types(df: DataFrame) -> DataFrame:
    """``(pos, column, type, nulls)``: the profile's first look at a table, one aggregate."""
    counts = df.agg(*[F.sum(qcol(c).isNull().cast("long")).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    rows = [(i, c, t, int(counts[i] or 0)) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "pos int, column string, type string, nulls long")
