"""Sinks and readers for the hand-offs between stages.

The reference hands stages off through record files and serialized
tensors; here every hand-off is Parquet with a declared schema: examples
(users, posts, interactions), feature files read back as float columns,
``(id, embedding)`` vector files, and Spark ML model folders.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import POST_DENSE_COLS, USER_DENSE_COLS

EMBEDDING_FILE = T.StructType([T.StructField("id", T.LongType()),
                               T.StructField("embedding", T.ArrayType(T.FloatType()))])


def write_examples(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each frame to ``out_dir/<name>`` (overwrite); returns paths."""
    paths = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def read_features(spark: SparkSession, pattern: str, key: str, cols: list[str]) -> DataFrame:
    """Read a glob of feature files keeping ``key`` and ``cols`` as float32,
    like a fixed-length feature description."""
    df = spark.read.parquet(pattern)
    return df.select(F.col(key), *[F.col(c).cast("float").alias(c) for c in cols])


def read_user_features(spark: SparkSession, pattern: str) -> DataFrame:
    return read_features(spark, pattern, "uid", USER_DENSE_COLS)


def read_post_features(spark: SparkSession, pattern: str) -> DataFrame:
    return read_features(spark, pattern, "po_id", POST_DENSE_COLS)


def write_embeddings(vectors: DataFrame, path: str) -> str:
    """``(id, embedding)`` rows, so every vector keeps its id."""
    vectors.select(F.col("id").cast("bigint"), F.col("embedding").cast("array<float>")) \
        .write.mode("overwrite").parquet(path)
    return path


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EMBEDDING_FILE).parquet(path)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    """``cls`` is the fitted model class, e.g. ``ALSModel``."""
    return cls.load(path)
