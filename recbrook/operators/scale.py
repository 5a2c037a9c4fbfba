"""Standard scaling with a global fit and no driver round trip.

The fit is one aggregate (mean and population standard deviation of every
column, NULLs ignored) evaluated as a single scalar subquery; the
transform is a projection that reads it.  Zero deviation scales by 1 and
NULL inputs stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit(df: DataFrame, cols: list[str]) -> Column:
    """A struct column holding ``<c>_mean`` and ``<c>_std`` for each column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.agg(F.struct(*aggs).alias("stats")).scalar()


def transform(df: DataFrame, cols: list[str], stats: Column) -> DataFrame:
    scaled = {}
    for c in cols:
        sd = stats[f"{c}_std"]
        scaled[c] = (F.col(c) - stats[f"{c}_mean"]) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return df.withColumns(scaled)


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return transform(df, cols, fit(df, cols))
