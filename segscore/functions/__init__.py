from segscore.functions.scalar import (  # noqa: F401
    boxcox, minmax, nan_to_null, pca2, qcol, standardize, yeojohnson,
)
