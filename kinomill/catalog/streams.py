"""Registered queries: incremental and streaming versions, on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import NA_MARKERS, format_values
from ..operators import constraints as C
from ..plans import domain as D
from ..session import scratch_path
from ..streaming import ingest as I
from ..streaming import speed as S


def _events(spark, d):
    """Events as a stream, with the time zone a watermark needs."""
    schema = D.table(spark, d, "events").schema
    stream = I.read_stream(spark, d, schema, pattern="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, stream):
    folder = scratch_path(spark, "stream")
    I.drain(stream, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def _plain(df, *columns):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if df.schema[c].dataType.typeName() == "timestamp" else F.col(c) for c in columns])


def stream_ingest(spark, d):
    return _plain(_drained(spark, _events(spark, d)), "event_id", "ts", "user_id", "event_type", "value", "props")


def stream_trusted(spark, d):
    marked = _events(spark, d).withColumn(
        "event_type", F.when(F.col("event_id") % 8 == 0, " N/A ").otherwise(F.concat(F.lit("  "), F.col("event_type")))
    )
    rules = [C.not_null("event_type"), C.in_range("value", 5, 400)]
    clean = I.trusted_stream(marked, rules, lambda s: format_values(s, NA_MARKERS))
    return _plain(_drained(spark, clean), "event_id", "ts", "event_type", "value")


def stream_dedupe(spark, d):
    """Every event arrives twice."""
    events = _events(spark, d).select("event_id", "ts", "user_id", "value")
    twice = events.unionByName(_events(spark, d).select("event_id", "ts", "user_id", "value"))
    return _plain(_drained(spark, I.dedupe_stream(twice, ["event_id"], "ts", "1 day")), "event_id", "ts", "user_id", "value")



def _window_result(spark, d, length, slide=None):
    def averages(df):
        return S.windowed(df, "ts", length, ["event_type"], slide, n=F.count("value"), avg_value=F.avg("value"))

    stream = _events(spark, d)
    emitted = _drained(spark, averages(stream.withWatermark("ts", "1 hour")))
    rows = D.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    recent = averages(S.rows_after(rows, "ts", emitted, length))
    served = S.serving_windows(emitted, recent).withColumn("avg_value", F.round("avg_value", 6))
    return _plain(served, "window_start", "window_end", "event_type", "n", "avg_value")


def stream_window_avg(spark, d):
    return _window_result(spark, d, "1 day")


def stream_sliding_avg(spark, d):
    return _window_result(spark, d, "12 hours", "6 hours")


def stream_sessions(spark, d):
    totals = {"n": F.count("event_id"), "total": F.sum("value")}
    emitted = _drained(
        spark, S.sessions(_events(spark, d).withWatermark("ts", "1 hour"), "ts", "2 hours", ["user_id"], **totals)
    )
    rows = D.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    served = S.serving_sessions(emitted, rows, "ts", "2 hours", ["user_id"], **totals)
    return _plain(served.withColumn("total", F.round("total", 4)), "session_start", "user_id", "n", "total")


def serving_view(spark, d):
    """Stored history up to 20 January and the stream beyond it."""
    batch = D.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).where("ts < timestamp '2024-01-20'")
    speed = _drained(spark, _events(spark, d))
    return _plain(S.serving_view(batch, speed, "ts", ["event_id"], "1 day"), "event_id", "ts", "user_id", "value")


def serving_view_late(spark, d):
    """Every seventh event is missing from the stored history and comes late, some without a time."""
    events = D.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = events.where("event_id % 7 <> 0")
    arrived = _drained(spark, _events(spark, d)).withColumn("ts", F.when(F.col("event_id") % 21 != 0, F.col("ts")))
    return _plain(S.serving_view(batch, arrived, "ts", ["event_id"]), "event_id", "ts", "user_id", "value")


def stream_late_rows(spark, d):
    """Events in two arrivals; what comes more than ten days behind the first arrival is kept apart, and nothing is lost."""
    folder = scratch_path(spark, "late")
    events = D.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for number, arrival in enumerate(("event_id % 3 <> 0", "event_id % 3 = 0")):
        events.where(arrival).coalesce(1).write.parquet(f"{folder}/in/{number}")
        stream = I.read_stream(spark, f"{folder}/in/*", events.schema)
        I.drain_with_late(stream, "ts", "10 days", f"{folder}/kept", f"{folder}/late", f"{folder}/checkpoint")
    both = [spark.read.schema(events.schema).parquet(f"{folder}/{name}").withColumn("late", F.lit(name == "late")) for name in ("kept", "late")]
    return _plain(both[0].unionByName(both[1]), "event_id", "ts", "user_id", "value", "late")


QUERIES = {
    f.__name__: f
    for f in (
        stream_ingest, stream_trusted, stream_dedupe, stream_window_avg, stream_sliding_avg, stream_sessions,
        serving_view, serving_view_late, stream_late_rows,
    )
}

ORACLE = {
    "stream_ingest": "select * from events",
    "stream_trusted": "select event_id, ts, event_type, value from events where event_id % 8 <> 0 and value between 5 and 400",
    "stream_dedupe": "select event_id, ts, user_id, value from events",
    "stream_window_avg": "select time_bucket(interval '1 day', ts) as window_start, time_bucket(interval '1 day', ts) + interval '1 day' as window_end, "
    "event_type, count(value) as n, round(avg(value), 6) as avg_value from events group by 1, 2, 3",
    "stream_sliding_avg": "select time_bucket(interval '6 hours', ts) - k * interval '6 hours' as window_start, "
    "time_bucket(interval '6 hours', ts) - k * interval '6 hours' + interval '12 hours' as window_end, "
    "event_type, count(value) as n, round(avg(value), 6) as avg_value from events cross join range(2) r(k) group by 1, 2, 3",
    "stream_sessions": "with a as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval '2 hours' then 0 else 1 end as fresh from events), "
    "b as (select *, sum(fresh) over (partition by user_id order by ts, event_id) as s from a) "
    "select min(ts) as session_start, user_id, count(*) as n, round(sum(value), 4) as total from b group by user_id, s",
    "serving_view": "select event_id, ts, user_id, value from events",
    "serving_view_late": "select event_id, case when event_id % 21 <> 0 then ts end as ts, user_id, value from events",
    "stream_late_rows": "select event_id, ts, user_id, value, coalesce(event_id % 3 = 0 and "
    "ts < (select max(ts) from events where event_id % 3 <> 0) - interval '10 days', false) as late from events",
}
