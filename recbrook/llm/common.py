"""Helpers that several operators share: materialised intermediates and
connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.
    Where it is unset, a local session gets one of its own; on a cluster that
    would be one machine's disk, so it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset; point it at storage all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-shared-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back:
    cuts the lineage, survives lost executors, and keeps column pruning.  The
    shuffle files of the write go as soon as it has ended, as nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes what ``written`` wrote for ``frames``, once nothing reads them again: what
    came of them has to be written itself."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *wanted: str) -> dict[str, str]:
    """Column names that clash with none of ``df`` (Spark compares without case)."""
    have = {c.lower() for c in df.columns}
    out = {}
    for w in wanted:
        n = f"__{w}"
        while n.lower() in have:
            n += "_"
        out[w] = n
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each id of an edge and the smallest id reachable.

    Alternates large-star and small-star steps (every vertex hands its
    neighbours its smallest neighbour) until the edges stay as they are.
    Minima are pre-aggregated before the shuffle and joined back, so a vertex
    with very many neighbours is a skewed join side that adaptive execution
    splits, never one group in one task.  Each step's edges are checkpointed.
    Self links and nulls are ignored; no edges give no rows.
    """
    shared_dir(edges.sparkSession)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter("u > v").distinct().checkpoint())

    def digest(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())

    before = digest(e)
    while before[0]:
        # Large star: the larger neighbours of u get u's smallest neighbour or u.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        e = (both.filter("v > u").join(low, F.col("u") == F.col("k"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: u's smaller neighbours and u itself get the smallest of them.
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        e = (e.join(low, F.col("u") == F.col("k"))
             .select(F.explode(F.array(
                 F.struct(F.col("u"), F.col("m").alias("v")),
                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
             .select("p.u", "p.v").filter("u > v").distinct().checkpoint())
        after = digest(e)
        if after == before:
            break
        before = after
    # Now every vertex but the roots has one edge, to its root.
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")) \
        .union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
