"""Pairwise-complete Pearson statistics.

One aggregate gives each column's mean; the second pass works on values less
that mean, so large means cancel before anything is squared. Per Arrow batch,
numpy forms the p×p sums over rows where both columns are present (``MᵀM``,
``XᵀM``, ``(X²)ᵀM``, ``XᵀX`` with NULL→0 and a presence mask M); each task
emits one row per pair i ≤ j and Spark sums them by pair. The shuffle is
``tasks × p²/2`` rows no matter how many data rows there are, and nothing but
the p×p result reaches the driver. (2 000+ ``corr`` expressions
in one aggregate overwhelm codegen; a vector ``Correlation.corr`` cannot do
pairwise-complete NULL handling.)
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import nan_to_null, qcol

PAIR_SCHEMA = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def column_means(df: DataFrame, features: list[str]) -> np.ndarray:
    """Mean of each column's present values (0 for none)."""
    row = df.agg(*[F.avg(nan_to_null(qcol(f).cast("double"))).alias(f"m{i}") for i, f in enumerate(features)]).first()
    m = np.array([0.0 if v is None else float(v) for v in row], float)
    return np.where(np.isfinite(m), m, 0.0)


def pair_sums(df: DataFrame, features: list[str], shift: np.ndarray | None = None) -> DataFrame:
    """``(i, j, n, sx, sy, sxx, syy, sxy)``, i ≤ j, of the values less
    ``shift`` (the column means) over rows where both column i and column j
    are non-NULL/non-NaN; i, j index ``features``."""
    shift = column_means(df, features) if shift is None else shift
    p = len(features)
    cols = [f"c{i}" for i in range(p)]
    sel = df.select(*[nan_to_null(qcol(f).cast("double")).alias(c) for f, c in zip(features, cols)])

    def part(batches):
        n = np.zeros((p, p)); sx = np.zeros((p, p)); sxx = np.zeros((p, p)); sxy = np.zeros((p, p))
        seen = False
        for b in batches:
            x = b[cols].to_numpy(dtype="float64", na_value=np.nan)
            if x.shape[0] == 0:
                continue
            seen = True
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x - shift, 0.0)
            n += m.T @ m
            sx += x0.T @ m          # sx[i, j] = Σ x_i over rows with both present
            sxx += (x0 * x0).T @ m
            sxy += x0.T @ x0
        if not seen:
            return
        u = np.triu_indices(p)
        import pandas as pd
        yield pd.DataFrame({
            "i": u[0].astype("int32"), "j": u[1].astype("int32"),
            "n": n[u], "sx": sx[u], "sy": sx.T[u], "sxx": sxx[u], "syy": sxx.T[u], "sxy": sxy[u],
        })

    partial = sel.mapInPandas(part, PAIR_SCHEMA)
    return partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ["n", "sx", "sy", "sxx", "syy", "sxy"]])


def pair_sums_matrix(df: DataFrame, features: list[str]) -> dict[str, np.ndarray]:
    """The summed statistics as p×p numpy arrays on the driver (p² numbers) and
    the ``shift`` that was taken off each column."""
    p = len(features)
    shift = column_means(df, features)
    mirror = {"n": "n", "sx": "sy", "sy": "sx", "sxx": "syy", "syy": "sxx", "sxy": "sxy"}
    out = {k: np.zeros((p, p)) for k in mirror}
    for r in pair_sums(df, features, shift).collect():
        for k, back in mirror.items():
            out[k][r["i"], r["j"]] = r[k]
            out[back][r["j"], r["i"]] = r[k]
    return {**out, "shift": shift}


def corr_from_sums(s: dict[str, np.ndarray]) -> np.ndarray:
    n, sx, sy, sxx, syy, sxy = (s[k] for k in ["n", "sx", "sy", "sxx", "syy", "sxy"])
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sy / n
        vx = sxx - sx * sx / n
        vy = syy - sy * sy / n
        r = cov / np.sqrt(vx * vy)
    r[(vx <= 0) | (vy <= 0) | (n < 2)] = np.nan
    return np.clip(r, -1.0, 1.0)


def corr_long(df: DataFrame, features: list[str]) -> DataFrame:
    """Upper triangle ``(idx1, idx2, feature_1, feature_2, corr, abs_corr)``
    computed by Spark from the pair sums; constant columns give NULL."""
    s = pair_sums(df, features).filter(F.col("i") < F.col("j"))
    names = F.array(*[F.lit(f) for f in features])
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.when((vx > 0) & (vy > 0) & (F.col("n") >= 2),
               F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cov / F.sqrt(vx * vy))))
    return s.select(
        F.col("i").alias("idx1"), F.col("j").alias("idx2"),
        names[F.col("i")].alias("feature_1"), names[F.col("j")].alias("feature_2"),
        r.alias("corr"),
    ).withColumn("abs_corr", F.abs("corr"))


def corr_bands(corr: DataFrame, lo: float, hi: float) -> DataFrame:
    """A9 + K1: pairs with |r| > hi are 'drop', lo < |r| <= hi are 'pca'
    (NULL/NaN never qualifies), sorted by |r| desc with the position pinned."""
    c = corr.filter(F.col("abs_corr").isNotNull() & ~F.isnan("abs_corr"))
    band = F.when(F.col("abs_corr") > hi, "drop").when(F.col("abs_corr") > lo, "pca")
    return c.withColumn("band", band).filter(F.col("band").isNotNull()).orderBy(
        F.col("abs_corr").desc(), "idx1", "idx2"
    )
