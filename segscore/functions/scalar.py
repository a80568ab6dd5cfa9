"""Column-expression builders (C1-C7). All stay JVM-side and codegen-able.

Feature names may hold blanks, ``/``, ``%``, ``(``, ``'``, ``¥`` or ``?``;
``qcol`` back-quotes every name so only a literal backtick needs escaping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(c: Column) -> Column:
    """NaN marks a missing value in the reference; NULL is Spark's missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def standardize(c: Column, mu: float, sd: float) -> Column:
    """(x - mu) / sd with population sd, a zero sd treated as 1."""
    return (c - F.lit(mu)) / F.lit(sd if sd not in (0.0, None) else 1.0)


def minmax(c: Column, lo: float, hi: float) -> Column:
    """(x - min) / (max - min), a zero range treated as 1, not clipped."""
    rng = (hi - lo) if hi is not None and lo is not None else None
    return (c - F.lit(lo)) / F.lit(rng if rng not in (0.0, None) else 1.0)


def boxcox(c: Column, lam: float) -> Column:
    """(x^l - 1)/l, ln x at l = 0 (NULL outside the domain x > 0)."""
    pos = F.when(c > 0, c)
    if abs(lam) < 1e-12:
        return F.log(pos)
    return (F.pow(pos, F.lit(lam)) - 1.0) / F.lit(lam)


def yeojohnson(c: Column, lam: float) -> Column:
    """C4: the four branches of the Yeo-Johnson transform."""
    if abs(lam) < 1e-12:
        pos = F.log1p(c)
    else:
        pos = (F.pow(c + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-c)
    else:
        neg = -(F.pow(1.0 - c, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(c >= 0, pos).otherwise(neg)


def pca2(c1: Column, c2: Column, mu1: float, mu2: float, w1: float, w2: float) -> Column:
    """Projection of a centred pair on its first principal axis."""
    return F.lit(w1) * (c1 - F.lit(mu1)) + F.lit(w2) * (c2 - F.lit(mu2))
