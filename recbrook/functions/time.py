"""Time functions on ``timestamp_ntz`` columns and timestamp arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, which starts Sunday = 1)."""
    return F.weekday(ts)


def adjacent_gaps_seconds(times: str) -> Column:
    """``[TIMESTAMP_DIFF(t[i+1], t[i], SECOND) for i in 0..n-2]`` in array
    order, whole elapsed seconds.  Fewer than two elements give ``[]``;
    NULL gives NULL.  Pure per-row array work: no shuffle, no window."""
    return F.expr(
        f"CASE WHEN size({times}) >= 2 THEN "
        f"zip_with(slice({times}, 2, size({times}) - 1), slice({times}, 1, size({times}) - 1), "
        f"(later, earlier) -> timestampdiff(SECOND, earlier, later)) "
        f"WHEN {times} IS NOT NULL THEN cast(array() AS array<bigint>) END")


def geometric_mean_positive(gaps: Column) -> Column:
    """``EXP(SUM(LN(g)) / COUNT(g))`` over the positive gaps; NULL when
    there is none (``LN`` of 0 is undefined, so non-positive gaps are
    left out)."""
    pos = F.filter(gaps, lambda g: g > 0)
    total = F.aggregate(pos, F.lit(0.0).cast("double"), lambda acc, g: acc + F.ln(g))
    return F.when(F.size(pos) > 0, F.exp(total / F.size(pos)))
