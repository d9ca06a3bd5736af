"""Speed layer and serving views.

A stream emits a window once the watermark has passed it, which keeps state
small but leaves the newest windows out. The serving views add those from the
ingested rows after the last emitted window, so they equal the batch result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import null_safe_join


def windowed(df: DataFrame, ts: str, length: str, by: Sequence[str], slide: str | None = None, **aggregates: Column) -> DataFrame:
    """Tumbling or sliding window aggregates; the same for batch and stream."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = df.groupBy(span.alias("w"), *by).agg(*[a.alias(n) for n, a in aggregates.items()])
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *aggregates)


def serving_windows(emitted: DataFrame, recent: DataFrame) -> DataFrame:
    """Emitted windows and, beyond the last of them, those of the ``recent`` rows."""
    last = emitted.agg(F.max("window_end").alias("m")).scalar()
    return emitted.unionByName(recent.where(last.isNull() | (F.col("window_end") > last)))


def rows_after(rows: DataFrame, ts: str, emitted: DataFrame, length: str) -> DataFrame:
    """Rows a window that was not emitted can contain: after the last end, less one window length."""
    last = emitted.agg(F.max("window_end").alias("m")).scalar()
    return rows.where(last.isNull() | (F.col(ts) >= last - F.expr(f"interval {length}")))


def sessions(df: DataFrame, ts: str, gap: str, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """Activity sessions: rows of a key less than ``gap`` apart."""
    grouped = df.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(*[a.alias(n) for n, a in aggregates.items()])
    return grouped.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, *aggregates)


def serving_sessions(emitted: DataFrame, rows: DataFrame, ts: str, gap: str, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """Closed sessions and, per key, those after its last closed one."""
    last = emitted.groupBy(*by).agg(F.max("session_end").alias("__last"))
    later = null_safe_join(rows, last, list(by), "left").where(F.col("__last").isNull() | (F.col(ts) >= F.col("__last")))
    return emitted.unionByName(sessions(later.drop("__last"), ts, gap, by, **aggregates))


def serving_view(batch: DataFrame, speed: DataFrame, ts: str, key: Sequence[str], lateness: str | None = None) -> DataFrame:
    """Batch table and the rows of the speed table that it lacks, by ``key``.

    Rows that tie with the newest batch row, come late, or have no time are kept.
    ``lateness`` (an interval) spares the scan of speed rows older than that before
    the newest batch row; use it only if nothing can be later.
    """
    if lateness is not None:
        mark = batch.agg(F.max(ts).alias("m")).scalar()
        recent = mark.isNull() | F.col(ts).isNull() | (F.col(ts) >= mark - F.expr(f"interval {lateness}"))
        speed = speed.where(recent)
    known = batch.select(*key).distinct()
    return batch.unionByName(speed.join(known, list(key), "left_anti"))
