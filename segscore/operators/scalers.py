"""Fitted scalers (M1, M2): fit = one aggregate, apply = one select.

Spark's ``ml.StandardScaler`` divides by the sample sd and ``MinMaxScaler``
maps a constant column to 0.5; the reference uses the population sd and
maps a constant to 0, so both are plain expressions here. Parameters come
back to the driver as one row per feature (bounded by the schema, not the
data) and become literals in the projection, which Catalyst folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import minmax, nan_to_null, qcol, standardize


def fit_standard(df: DataFrame, features: list[str]) -> DataFrame:
    """Parameter table ``(pos, feature, mean, std)``, std = population sd."""
    aggs = []
    for f in features:
        x = nan_to_null(qcol(f).cast("double"))
        aggs += [F.avg(x), F.stddev_pop(x)]
    row = df.agg(*aggs).collect()[0]
    spark = df.sparkSession
    rows = [(i, f, row[2 * i], row[2 * i + 1]) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "pos int, feature string, mean double, std double")


def fit_minmax(df: DataFrame, features: list[str]) -> DataFrame:
    """Parameter table ``(pos, feature, min, max)``."""
    aggs = []
    for f in features:
        x = nan_to_null(qcol(f).cast("double"))
        aggs += [F.min(x), F.max(x)]
    row = df.agg(*aggs).collect()[0]
    rows = [(i, f, row[2 * i], row[2 * i + 1]) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "pos int, feature string, min double, max double")


def _params(p: DataFrame, a: str, b: str) -> list[tuple[str, float, float]]:
    return [(r["feature"], r[a], r[b]) for r in p.orderBy("pos").collect()]


def apply_standard(df: DataFrame, params: DataFrame | list, passthrough: list[str] = ("id", "label")) -> DataFrame:
    ps = params if isinstance(params, list) else _params(params, "mean", "std")
    names = {f for f, _, _ in ps}
    keep = [qcol(c) for c in df.columns if c not in names and c in passthrough]
    return df.select(*keep, *[standardize(nan_to_null(qcol(f).cast("double")), m, s).alias(f) for f, m, s in ps])


def apply_minmax(df: DataFrame, params: DataFrame | list, passthrough: list[str] = ("id", "label")) -> DataFrame:
    ps = params if isinstance(params, list) else _params(params, "min", "max")
    names = {f for f, _, _ in ps}
    keep = [qcol(c) for c in df.columns if c not in names and c in passthrough]
    return df.select(*keep, *[minmax(nan_to_null(qcol(f).cast("double")), lo, hi).alias(f) for f, lo, hi in ps])


def standard_params_list(df: DataFrame, features: list[str]) -> list[tuple[str, float, float]]:
    return _params(fit_standard(df, features), "mean", "std")


def minmax_params_list(df: DataFrame, features: list[str]) -> list[tuple[str, float, float]]:
    return _params(fit_minmax(df, features), "min", "max")
