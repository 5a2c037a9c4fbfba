"""The whole transformation job: features of users, posts and interactions
built from the tables and published as one set of example tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import round_all
from ..operators import clean
from ..operators.encode import POST_TEXT_LENGTHS, USER_TEXT_LENGTHS
from ..operators.users import COUNTED_TYPES
from ..schemas import POST_DENSE_COLS
from . import features as FT

TABLES = ("users", "posts", "interactions")


def example_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``users``: counts, scaled login frequency, padded text ids, location
    features; ``posts``: scaled features and padded text ids; ``interactions``:
    cleaned rows, negatives included."""
    x = FT.Inputs.load(spark, sf_dir)
    iwn = FT.interactions_with_negatives(x)
    _, eu, ep = FT.encoded_tables(x, iwn)
    users = (FT.scaled_user_features(FT.user_numeric(x)).join(eu.select("uid", *USER_TEXT_LENGTHS), "uid")
             .join(FT.location_features(x.profile).select("uid", round_all(F.col("geo_rbf")).alias("geo_rbf")), "uid"))
    posts = FT.scaled_post_features(FT.post_numeric(x)).join(ep.select("po_id", *POST_TEXT_LENGTHS), "po_id")
    return {"users": users.select("uid", *COUNTED_TYPES, F.round("login_frequency", 6).alias("login_frequency"),
                                  *USER_TEXT_LENGTHS, "geo_rbf"),
            "posts": posts.select("po_id", *[F.round(c, 6).alias(c) for c in POST_DENSE_COLS], *POST_TEXT_LENGTHS),
            "interactions": clean.clean_interactions(iwn)}


def publish(tables: dict[str, DataFrame], out_dir: str) -> str:
    """Write the tables as one new version under ``out_dir``; returns its name.

    Each version has a folder of its own, and the list of its tables is
    written last: readers take the newest version that has a whole list, so a job
    that dies half way leaves the version before in force, and no reader sees
    tables of two versions.  Names ascend with the time."""
    spark = next(iter(tables.values())).sparkSession
    stamp = spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMddHHmmssSSS') AS s").first().s
    version = f"version={stamp}-{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        df.write.parquet(os.path.join(out_dir, version, name))
    spark.createDataFrame([(n,) for n in tables], "name string").coalesce(1).write.parquet(
        os.path.join(out_dir, version, "published"))
    return version


def newest_version(spark: SparkSession, out_dir: str) -> str | None:
    """The newest version whose list is whole."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(root)]  # a folder a version
    whole = [n for n in names if n.startswith("version=")
             and fs.exists(jvm.org.apache.hadoop.fs.Path(root, f"{n}/published/_SUCCESS"))]
    return max(whole, default=None)


def read_published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    version = newest_version(spark, out_dir)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {out_dir}")
    folder = os.path.join(out_dir, version)
    names = [r.name for r in spark.read.parquet(os.path.join(folder, "published")).collect()]
    return {n: spark.read.parquet(os.path.join(folder, n)) for n in names}


def run(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """The job end to end: build, publish, and read what was published."""
    publish(example_tables(spark, sf_dir), out_dir)
    return read_published(spark, out_dir)
