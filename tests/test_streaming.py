"""Streams: exactly once over restarts, late rows, equality with batch."""

import pytest
from pyspark.sql import functions as F

from kinomill.operators import constraints as C
from kinomill.session import scratch_path
from kinomill.streaming import ingest as I
from kinomill.streaming import speed as S

SCHEMA = "id bigint, k string, ts timestamp, v double"


def _write(spark, folder, rows):
    df = spark.createDataFrame(rows, "id bigint, k string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test")


def test_restart_continues(spark, folder):
    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 00:00:00", 1.0)])
    _write(spark, f"{folder}/in", [(2, "a", "2024-01-01 00:01:00", 1.0)])
    for expected in (2, 2):
        I.drain(I.read_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1), f"{folder}/out", f"{folder}/ck")
        assert spark.read.parquet(f"{folder}/out").count() == expected
    _write(spark, f"{folder}/in", [(3, "a", "2024-01-01 00:02:00", 1.0)])
    I.drain(I.read_stream(spark, f"{folder}/in", SCHEMA), f"{folder}/out", f"{folder}/ck")
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3]


def test_dedupe_across_batches(spark, folder):
    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 00:00:00", 1.0), (1, "a", "2024-01-01 00:00:00", 1.0)])
    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 00:05:00", 1.0), (2, "b", "2024-01-01 00:06:00", 1.0)])
    stream = I.dedupe_stream(I.read_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1), ["id"], "ts", "1 hour")
    I.drain(stream, f"{folder}/out", f"{folder}/ck")
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2]


def test_windows_late_rows_and_serving(spark, folder):
    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 00:10:00", 1.0), (2, "a", "2024-01-01 05:00:00", 3.0)])
    by_hour = {"n": F.count("v"), "total": F.sum("v")}

    def drain():
        stream = I.read_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1).withWatermark("ts", "1 hour")
        return I.drain(S.windowed(stream, "ts", "1 hour", ["k"], **by_hour), f"{folder}/out", f"{folder}/ck")

    drain()
    # Behind the watermark of 04:00, so the stream drops it.
    _write(spark, f"{folder}/in", [(3, "a", "2024-01-01 00:20:00", 9.0)])
    progress = drain()
    dropped = sum(o["numRowsDroppedByWatermark"] if isinstance(o, dict) else o.numRowsDroppedByWatermark for p in progress for o in _operators(p))
    assert dropped == 1
    emitted = spark.read.parquet(f"{folder}/out")
    assert [(r.n, r.total) for r in emitted.collect()] == [(1, 1.0)]
    rows = spark.read.parquet(f"{folder}/in")
    recent = S.windowed(S.rows_after(rows, "ts", emitted, "1 hour"), "ts", "1 hour", ["k"], **by_hour)
    served = S.serving_windows(emitted, recent).orderBy("window_start").collect()
    assert [(r.n, r.total) for r in served] == [(1, 1.0), (1, 3.0)]


def _operators(progress):
    if "stateOperators" in progress:
        return progress["stateOperators"]
    return progress.get("_stateOperators", [])


def test_trusted_stream_keeps_no_state(spark, folder):
    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 00:00:00", 1.0), (2, None, "2024-01-01 00:00:00", 99.0)])
    stream = I.trusted_stream(I.read_stream(spark, f"{folder}/in", SCHEMA), [C.not_null("k"), C.in_range("v", 0, 10)])
    progress = I.drain(stream, f"{folder}/out", f"{folder}/ck")
    assert [r.id for r in spark.read.parquet(f"{folder}/out").collect()] == [1]
    assert not any(_operators(p) for p in progress)


def test_serving_view_without_batch_rows(spark):
    speed = spark.createDataFrame([(1,), (2,)], "t int")
    assert S.serving_view(speed.where("false"), speed, "t", ["t"]).count() == 2
    assert sorted(r.t for r in S.serving_view(speed.where("t = 1"), speed, "t", ["t"]).collect()) == [1, 2]


def test_serving_view_keeps_ties_and_late_rows(spark):
    rows = [(1, 5), (2, 5), (3, 1), (4, None)]
    speed = spark.createDataFrame(rows, "id int, t int")
    view = S.serving_view(speed.where("id = 1"), speed, "t", ["id"])
    assert sorted(r.id for r in view.collect()) == [1, 2, 3, 4]


def test_late_rows_are_kept_apart(spark, folder):
    """Also after a restart, and when a batch is written a second time; a hot key is rows like others."""
    def drain():
        I.drain_with_late(I.read_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1), "ts", "1 hour", f"{folder}/kept", f"{folder}/late", f"{folder}/ck")

    def ids(name):
        return sorted(r.id for r in spark.read.parquet(f"{folder}/{name}").collect())

    _write(spark, f"{folder}/in", [(1, "a", "2024-01-01 05:00:00", 1.0), (2, "a", "2024-01-01 00:00:00", 1.0)])
    drain()
    assert (ids("kept"), ids("late")) == ([1, 2], [])  # the first batch has no watermark yet
    _write(spark, f"{folder}/in", [(3, "a", "2024-01-01 03:59:59", 1.0), (4, "a", "2024-01-01 04:00:00", 1.0), (5, None, None, 1.0)])
    drain()
    _write(spark, f"{folder}/in", [(6, "a", "2024-01-01 00:30:00", 1.0)] * 50)
    drain()
    assert (ids("kept"), ids("late")) == ([1, 2, 4, 5], [3] + [6] * 50)
    drain()
    assert len(ids("kept")) + len(ids("late")) == 55
