"""Profiles and moments.

Wide tables are unpivoted to ``(feature, value)`` so one grouped aggregate
covers any number of columns: map-side partial aggregation keeps the shuffle
at ``partitions × features`` rows whatever the row count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import nan_to_null, qcol
from segscore.operators.ranking import global_running


def long_values(df: DataFrame, features: list[str], keep: list[str] = ("id",)) -> DataFrame:
    """``(keep..., feature, value)`` with NaN turned into NULL, NULLs removed."""
    keep = [k for k in keep if k in df.columns]
    wide = df.select(*[qcol(k) for k in keep],
                     *[nan_to_null(qcol(f).cast("double")).alias(f) for f in features])
    return (
        wide.unpivot(keep, features, "feature", "value")
        .filter(F.col("value").isNotNull())
    )


def spread(df: DataFrame) -> DataFrame:
    """Before a per-row fan-out (grid joins), make sure the rows sit in at
    least ``defaultParallelism`` partitions: a single-row-group file would
    otherwise put all the expanded work in one task."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """A3."""
    return df.groupBy(qcol(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))


def moments(df: DataFrame, features: list[str]) -> DataFrame:
    """A4-A7 per feature: n, mean, population sd, min, max, biased skewness g1."""
    lv = long_values(df, features, keep=[])
    return lv.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("sd_pop"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skew"),
    )


def exact_quantiles(df: DataFrame, features: list[str], probs: list[float], id_col: str = "id") -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont``) per feature.

    No value list is gathered per group: the long table is globally sorted
    by (feature, value, id) with range partitioning, ranks come from
    partition offsets, and only the ≤ 2·|probs| rows per feature at the
    needed ranks are joined back."""
    lv = long_values(df, features, keep=[id_col])
    ranked = global_running(
        lv, [F.col("value").asc(), F.col(id_col).asc()], partition_by=["feature"], rank_col="r"
    )
    n = ranked.groupBy("feature").agg(F.max("r").alias("n"))
    qs = F.explode(F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("q")) for i, p in enumerate(probs)]))
    pos = n.select("feature", "n", qs.alias("_q")).select(
        "feature", "n", "_q.qi", "_q.q", (F.col("_q.q") * (F.col("n") - 1)).alias("h"),
    ).select("*", (F.floor("h") + 1).cast("long").alias("r_lo"), (F.ceil("h") + 1).cast("long").alias("r_hi"))
    need = ranked.select("feature", "r", "value")
    lo = need.withColumnRenamed("r", "r_lo").withColumnRenamed("value", "v_lo")
    hi = need.withColumnRenamed("r", "r_hi").withColumnRenamed("value", "v_hi")
    out = pos.join(lo, ["feature", "r_lo"]).join(hi, ["feature", "r_hi"])
    return out.select(
        "feature", "q",
        (F.col("v_lo") + (F.col("h") - F.floor("h")) * (F.col("v_hi") - F.col("v_lo"))).alias("value"),
    )


def describe(df: DataFrame, features: list[str]) -> DataFrame:
    """A1: count, mean, sample sd, min, quartiles, max per feature."""
    lv = long_values(df, features, keep=[])
    base = lv.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(df, features, [0.25, 0.5, 0.75])
    qw = q.groupBy("feature").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.toDF("feature", "q25", "q50", "q75")
    return base.join(qw, "feature")


def outlier_profile(df: DataFrame, features: list[str], k: float = 1.5) -> DataFrame:
    """IQR fences from exact quartiles and the counts outside them."""
    q = exact_quantiles(df, features, [0.25, 0.75])
    f = q.groupBy("feature").pivot("q", [0.25, 0.75]).agg(F.first("value")).toDF("feature", "q1", "q3")
    f = f.select("feature", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    f = f.select("*", (F.col("q1") - k * F.col("iqr")).alias("lo_fence"), (F.col("q3") + k * F.col("iqr")).alias("hi_fence"))
    lv = long_values(df, features, keep=[])
    # fences: one row per feature → broadcast is bounded by the feature count
    return lv.join(F.broadcast(f), "feature").groupBy("feature", "q1", "q3", "iqr", "lo_fence", "hi_fence").agg(
        F.sum((F.col("value") < F.col("lo_fence")).cast("long")).alias("n_low"),
        F.sum((F.col("value") > F.col("hi_fence")).cast("long")).alias("n_high"),
    )


def impute_median(df: DataFrame, features: list[str], passthrough: list[str] = ("id", "label")) -> DataFrame:
    """NULL/NaN → exact median of the column."""
    med = {r["feature"]: r["value"] for r in exact_quantiles(df, features, [0.5]).collect()}
    return df.select(
        *[qcol(c) for c in passthrough if c in df.columns],
        *[F.coalesce(nan_to_null(qcol(c)), F.lit(med.get(c))).alias(c) for c in features],
    )


def histogram(df: DataFrame, features: list[str], bins: int = 30, by: str | None = "label") -> DataFrame:
    """A10: equal-width bins between each column's min and max (last bin
    closed), optionally split by class."""
    keep = [by] if by else []
    lv = long_values(df, features, keep=keep)
    rng = lv.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    w = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    b = F.when(F.col("mx") == F.col("mn"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("mn")) / w), F.lit(bins - 1))
    ).cast("int")
    j = lv.join(F.broadcast(rng), "feature").withColumn("bin", b)
    keys = ["feature"] + keep + ["bin"]
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("mn") + F.col("bin") * w).alias("lo"),
    )


def kde(df: DataFrame, features: list[str], points: int = 64) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, sample sd) on a ``points`` grid from
    min to max. Equal values are counted first (map-side combined), so each
    distinct value meets the grid once; the grid is a bounded per-feature table."""
    lv = long_values(df, features, keep=[])
    st = lv.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"),
        F.stddev_samp("value").alias("sd"),
    )
    grid = st.select(
        "feature", "n",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"),
        "mn", "mx",
        (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
    ).select("feature", "n", "k", "h",
             (F.col("mn") + F.col("k") * (F.col("mx") - F.col("mn")) / F.lit(float(points - 1))).alias("x"))
    z = (F.col("x") - F.col("value")) / F.col("h")
    counted = lv.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("times"))
    dens = counted.join(F.broadcast(grid), "feature").groupBy("feature", "k", "x", "n", "h").agg(
        F.sum(F.col("times") * F.exp(-0.5 * z * z)).alias("s")
    )
    return dens.select(
        "feature", "k", "x",
        (F.col("s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
    )


def hash_uniform(*parts: Column) -> Column:
    """A uniform in [0, 1) from the first 8 hex digits of md5 — identical in
    every engine that has md5 and stable across task retries (unlike rand)."""
    h = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_sample(df: DataFrame, fraction: float, seed: int, id_col: str = "id") -> DataFrame:
    """Seeded, retry-stable Bernoulli sample by id."""
    return df.filter(hash_uniform(qcol(id_col), F.lit(seed)) < F.lit(fraction))
