"""segscore: cluster-then-score risk modelling on Spark DataFrames.

Every fitted step is a small parameter DataFrame plus a builder of column
expressions, so fitting is one aggregate job and applying is a ``select``
that Catalyst can prune, fold and codegen.
"""

__version__ = "0.1.0"
