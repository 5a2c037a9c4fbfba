"""Readers for the given tables, always with a declared schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BASE


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")



def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one base table.  Column pruning and filters reach the Parquet
    reader because nothing here materialises rows."""
    return spark.read.schema(BASE[name]).parquet(table_path(sf_dir, name))
