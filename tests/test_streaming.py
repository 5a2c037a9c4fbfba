"""Streaming: replays counted once, malformed messages routed aside,
counts equal to the batch job."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from recbrook.schemas import BASE
from recbrook.streaming import jobs
from recbrook.streaming.intake import parse_messages

T = dt.datetime


def _events(spark, rows):
    return spark.createDataFrame(rows, BASE["events"])


def test_replayed_event_counted_once_and_late_event_kept(spark):
    src = tempfile.mkdtemp(prefix="recbrook-stream-")
    a = [(1, T(2024, 1, 1, 0, 0), 7, "view", 1.0, '{"k": 3}'),
         (2, T(2024, 1, 1, 0, 5), 7, "click", 2.0, '{"k": 3}')]
    b = [(2, T(2024, 1, 1, 0, 5), 7, "click", 2.0, '{"k": 3}'),    # replay of event 2
         (3, T(2024, 1, 1, 0, 6), 8, "view", 1.0, '{"k": 4}')]
    c = [(4, T(2023, 6, 1), 8, "view", 1.0, '{"k": 4}'),            # months late
         (1, T(2024, 1, 1, 0, 0), 7, "view", 1.0, '{"k": 3}')]     # replay of event 1
    _events(spark, a).coalesce(1).write.parquet(os.path.join(src, "events_a.parquet"))
    _events(spark, b).coalesce(1).write.parquet(os.path.join(src, "events_b.parquet"))
    _events(spark, c).coalesce(1).write.parquet(os.path.join(src, "events_c.parquet"))
    out = jobs.stream_counts(spark, src + "/*", "*.parquet")
    got = sorted((r.user_id, r.interaction_type, r.n) for r in out.collect())
    assert got == [(7, "comment", 1), (7, "view", 1), (8, "view", 2)]


def test_malformed_messages_routed_aside(spark):
    raw = spark.createDataFrame([
        ('{"event_id": 1, "ts": "2024-01-01T00:00:07.179575", "user_id": 8, "event_type": "view", '
         '"value": 6.55, "props": "{\\"k\\": 69}"}',),
        ("{not json",),
    ], "value string")
    good, bad = parse_messages(raw)
    g = good.collect()
    assert len(g) == 1 and g[0].event_id == 1 and g[0].ts == T(2024, 1, 1, 0, 0, 7, 179575)
    assert [r.value for r in bad.collect()] == ["{not json"]


def test_stream_counts_equal_batch(spark):
    from recbrook.sources import derived as D
    d = "/root/testdata/sf0.001"
    s = jobs.stream_counts(spark, d, "events.parquet")
    b = (D.interactions(spark, d).groupBy("user_id", "interaction_type")
         .agg(F.count(F.lit(1)).alias("n")))
    key = lambda r: (r.user_id, r.interaction_type or "", r.n)
    assert sorted(map(key, s.collect())) == sorted(map(key, b.collect()))


def test_second_call_goes_on_from_the_first(spark):
    src, state = tempfile.mkdtemp(prefix="recbrook-stream-"), tempfile.mkdtemp(prefix="recbrook-state-")
    a = [(1, T(2024, 1, 1), 7, "view", 1.0, '{"k": 3}'), (2, T(2024, 1, 1), 8, "click", 2.0, '{"k": 3}')]
    b = [(2, T(2024, 1, 1), 8, "click", 2.0, '{"k": 3}'), (3, T(2023, 1, 1), 7, "view", 1.0, '{"k": 4}')]
    _events(spark, a).coalesce(1).write.parquet(os.path.join(src, "a.parquet"))
    one = jobs.stream_refresh(spark, src + "/*", "*.parquet", state_dir=state).collect()
    assert sorted(map(tuple, one)) == [(7, 1, 0, 0), (8, 0, 0, 1)]
    _events(spark, b).coalesce(1).write.parquet(os.path.join(src, "b.parquet"))
    two = jobs.stream_refresh(spark, src + "/*", "*.parquet", state_dir=state).collect()
    assert sorted(map(tuple, two)) == [(7, 2, 0, 0), (8, 0, 0, 1)]
    # nothing new: same counts; the second batch refreshed only the user it touched
    again = jobs.stream_counts(spark, src + "/*", "*.parquet", state_dir=state).collect()
    assert sorted(map(tuple, again)) == [(7, "view", 2), (8, "comment", 1)]
    users = spark.read.parquet(os.path.join(state, "users"))
    assert [r.uid for r in users.filter("batch_id = 1").collect()] == [7]


def test_work_of_a_batch_does_not_grow(spark, tmp_path):
    """Equal batches update equally many keys, however much came before; the
    state grows with the distinct events and users only."""
    for f in range(6):
        rows = [(f * 40 + i, T(2024, 1, 1), i % 10, "view", 1.0, '{"k": 3}') for i in range(40)]
        rows += [(0, T(2024, 1, 1), 0, "view", 1.0, '{"k": 3}')] * 5  # repeats of the first event
        _events(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in" / f"{f}.parquet"))
    users, progress = jobs.consume(spark, str(tmp_path / "in") + "/*", "*.parquet", str(tmp_path / "state"), files_per_batch=1)
    work = [(p["numInputRows"], sum(o["numRowsUpdated"] for o in p["stateOperators"])) for p in progress if p["numInputRows"]]
    assert len(work) == 6 and {n for n, _ in work} == {45} and max(u for _, u in work) <= 50
    assert [p["stateOperators"][0]["customMetrics"].get("rocksdbGetCount") for p in progress][0] is not None  # the keyed store
    per_batch = spark.read.parquet(users).filter("batch_id >= 0").groupBy("batch_id").count().collect()
    assert {r["count"] for r in per_batch} == {10}
    got = jobs.last_totals(spark, users).agg(F.sum("viewed_posts"), F.sum("n_view")).first()
    assert tuple(got) == (240, 240)
