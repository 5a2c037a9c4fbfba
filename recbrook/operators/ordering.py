"""Global order without a single-partition window.

A window with no PARTITION BY moves every row to one task.  These helpers
get the same answers from range partitioning: each range partition is
numbered on its own, and the per-partition totals (one row per partition,
so bounded by the partition count) give each partition its offset.

The locally numbered frame is checkpointed (to the shared checkpoint
folder) before its totals are taken.  Range bounds come from sampling the
input, and a recomputed input may arrive in another row order; reading
one materialised copy keeps the partition ids of both branches equal, and
cuts the lineage so a lost executor does not recompute the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _ranged(df: DataFrame, order: list[Column], n_parts: int | None) -> DataFrame:
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())


def _materialise(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _offsets(ranged: DataFrame, value: Column, name: str) -> DataFrame:
    """``(_pid, name)``: the total of ``value`` over all earlier partitions."""
    tot = ranged.groupBy("_pid").agg(F.sum(value).alias("_tot"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return tot.select("_pid", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias(name))


def global_index(df: DataFrame, order: list[Column], name: str = "idx",
                 n_parts: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (ties in arbitrary order);
    the distributed equivalent of ``row_number() OVER (ORDER BY ...) - 1``."""
    r = _ranged(df, order, n_parts)
    local = _materialise(r.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1))
    offs = _offsets(local, F.lit(1), "_off")
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_local", "_off"))


def running_sum_before(df: DataFrame, order: list[Column], value: str, name: str,
                       n_parts: int | None = None) -> DataFrame:
    """Sum of ``value`` over all rows strictly before each row in
    ``order``, computed per range partition plus partition offsets."""
    r = _ranged(df, order, n_parts)
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = _materialise(r.withColumn("_local", F.coalesce(F.sum(value).over(w), F.lit(0))))
    offs = _offsets(local, F.col(value), "_off")
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_pid", "_local", "_off"))
