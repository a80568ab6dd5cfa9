"""Global order without a single-task window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
Here the sort is a range-partitioned ``orderBy`` (ties are split by the
unique tie-break key, so one hot score cannot land in one task), each row
gets its position inside its partition, the tiny per-partition totals are
turned into offsets, and offsets are joined back (one row per partition and
group). The tagged sort is checkpointed to the shared
checkpoint folder so every later pass sees the same partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segscore.session import cut_lineage

_PID = "_pid"
_MID = "_mid"


def _sorted_tagged(df: DataFrame, order: list[Column]) -> DataFrame:
    s = df.orderBy(*order).withColumn(_MID, F.monotonically_increasing_id())
    s = s.withColumn(_PID, F.shiftright(F.col(_MID), 33))
    return cut_lineage(s)


def global_running(
    df: DataFrame,
    order: list[Column],
    values: list[str] = (),
    partition_by: list[str] = (),
    rank_col: str = "_rank",
) -> DataFrame:
    """Adds ``rank_col`` (1-based position in ``order``) and ``cum_<v>``
    (inclusive running sum, NULL counts 0) for each value column, restarted per
    ``partition_by`` group (NULL keys form a group). ``order`` must end in a
    unique key. One plan at every size."""
    values, by = list(values), list(partition_by)
    s = _sorted_tagged(df, [F.col(c).asc() for c in by] + list(order))
    # one row per (sorted partition, group) → exclusive offsets inside the group
    tot = s.groupBy(_PID, *by).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_t_{v}") for v in values])
    before = (Window.partitionBy(*by) if by else Window).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        F.col(_PID).alias("_o_pid"), *[F.col(c).alias(f"_o_by_{c}") for c in by],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o_n"),
        *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
    )
    on = F.col(_PID) == F.col("_o_pid")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_o_by_{c}"))
    # without groups the offsets are bounded by the partition count → safe to broadcast
    s = s.join(off if by else F.broadcast(off), on)
    inside = Window.partitionBy(_PID, *by).orderBy(_MID)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn(rank_col, F.col("_o_n") + F.row_number().over(inside))
    for v in values:
        s = s.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.coalesce(F.sum(F.col(v)).over(running), F.lit(0)))
    return s.drop(_PID, _MID, "_o_pid", "_o_n", *[f"_o_by_{c}" for c in by], *[f"_o_{v}" for v in values])
