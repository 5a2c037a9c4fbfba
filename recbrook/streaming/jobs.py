"""Streaming jobs: running interaction counts and refresh-on-arrival.

The state is keyed and kept by the stream itself in a RocksDB state store:
the ids of the events seen (``dropDuplicates``) and the counts of each user (a
grouped aggregation).  A micro-batch looks up and updates the keys of its own
rows only; what came before is neither read again nor recounted, and an event
counts once however late it or its repeat comes (a watermark would drop late
events).  Each batch writes the new totals of the users it touched under its
batch id, so a replayed batch overwrites itself.  The folder and the stream's
checkpoint are kept, so a later call goes on where the last one ended.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BASE
from ..session import scratch_path
from ..sources.derived import INTERACTION_TYPE_OF_EVENT, interactions_from_events
from ..operators.users import COUNTED_TYPES

EVENT_COLS = ["event_id", "user_id", "post_id", "interaction_type"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Every value ``interaction_type`` takes, and the column of its count.
TYPES = [*dict.fromkeys([*INTERACTION_TYPE_OF_EVENT.values(), "error"]), None]
COUNT_OF = {t: f"n_{t or 'none'}" for t in TYPES}


def event_stream(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Event files arriving under ``source_dir`` as a stream."""
    reader = spark.readStream.schema(BASE["events"]).option("pathGlobFilter", file_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source_dir)


def run_per_batch(stream: DataFrame, per_batch: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> list[dict]:
    """Run ``per_batch`` on each micro-batch until the available input is
    consumed; returns the progress report of each batch."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return [dict(p) for p in q.recentProgress]


def _part(table: str, batch_id: int) -> str:
    return os.path.join(table, f"batch_id={batch_id}")


def running_totals(events: DataFrame) -> DataFrame:
    """(uid, the counted columns, one count per interaction type) over the
    distinct events of a stream."""
    t = F.col("interaction_type")
    counted = [F.count(F.when(t == v, F.col("post_id"))).alias(c) for c, v in COUNTED_TYPES.items()]
    each = [F.count(F.when(t.eqNullSafe(F.lit(v)), 1)).alias(c) for v, c in COUNT_OF.items()]
    return events.select(*EVENT_COLS).dropDuplicates(["event_id"]).groupBy(F.col("user_id").alias("uid")).agg(*counted, *each)


def consume(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet", state_dir: str | None = None,
            files_per_batch: int | None = None) -> tuple[str, list[dict]]:
    """Take in the events that have arrived; returns the folder of the users'
    totals, a part per batch, and the batches' progress."""
    state_dir = state_dir or scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    users = os.path.join(state_dir, "users")
    columns = ", ".join(f"{c} bigint" for c in ("uid", *COUNTED_TYPES, *COUNT_OF.values()))
    spark.createDataFrame([], columns).write.mode("ignore").parquet(_part(users, -1))
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        totals = running_totals(interactions_from_events(event_stream(spark, source_dir, file_glob, files_per_batch)))
        progress = run_per_batch(
            totals, lambda batch, batch_id: batch.write.mode("overwrite").parquet(_part(users, batch_id)),
            os.path.join(state_dir, "checkpoint"), "update")
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return users, progress


def last_totals(spark: SparkSession, users: str) -> DataFrame:
    """Each user's newest row of the totals."""
    table = spark.read.parquet(users)
    rest = [c for c in table.columns if c not in ("uid", "batch_id")]
    return table.groupBy("uid").agg(F.max(F.struct("batch_id", *rest)).alias("last")).select("uid", "last.*")


def stream_counts(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet",
                  state_dir: str | None = None) -> DataFrame:
    """Running (user_id, interaction_type) counts over the event stream.
    ``state_dir`` holds the state between calls; None starts anew."""
    users, _ = consume(spark, source_dir, file_glob, state_dir)
    per_type = F.array(*[F.struct(F.lit(t).cast("string").alias("interaction_type"), F.col(c).alias("n"))
                         for t, c in COUNT_OF.items()])
    return (last_totals(spark, users).select(F.col("uid").alias("user_id"), F.inline(per_type)).filter(F.col("n") > 0))


def stream_refresh(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet",
                   state_dir: str | None = None) -> DataFrame:
    """Refresh on arrival: each micro-batch refreshes the counts of the users
    it touches; returns every such user's last counts."""
    users, _ = consume(spark, source_dir, file_glob, state_dir)
    return last_totals(spark, users).select("uid", *COUNTED_TYPES)


def stream_messages(spark: SparkSession, message_dir: str, state_dir: str | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Parse the JSON messages arriving under ``message_dir``: returns the
    (parsed, malformed) tables written by the stream."""
    from .intake import parse_messages, message_stream
    state_dir = state_dir or scratch_path(spark, f"stream-messages-{uuid.uuid4().hex}")
    out = os.path.join(state_dir, "rows")

    def split(batch: DataFrame, batch_id: int) -> None:
        good, bad = parse_messages(batch)
        good.select(F.lit(None).cast("string").alias("malformed"), "*").unionByName(
            bad.select(F.col("value").alias("malformed")), allowMissingColumns=True) \
            .write.mode("overwrite").parquet(_part(out, batch_id))

    run_per_batch(message_stream(spark, message_dir), split, os.path.join(state_dir, "checkpoint"))
    rows = spark.read.parquet(out).drop("batch_id")
    return (rows.filter(F.col("malformed").isNull()).drop("malformed"),
            rows.filter(F.col("malformed").isNotNull()).select("malformed"))
