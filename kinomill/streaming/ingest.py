"""Incremental file ingest on Structured Streaming.

Every drain uses ``availableNow``: it takes what has arrived, in batches of
bounded size, and stops. The checkpoint remembers files and state, so running
it again continues where the last run ended, exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.constraints import Rule, apply_constraints

FILES_PER_BATCH = 1_000


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    pattern: str = "*.parquet",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def drain(stream: DataFrame, target: str, checkpoint: str) -> list[dict]:
    """Append all available rows to a Parquet table; returns the progress reports."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [dict(p) if isinstance(p, dict) else p.__dict__ for p in query.recentProgress]


def trusted_stream(stream: DataFrame, rules: Sequence[Rule], prepare=None) -> DataFrame:
    """The batch column functions and rules on a stream; keeps no state."""
    ready = stream if prepare is None else prepare(stream)
    return apply_constraints(ready, rules)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; a key is forgotten once the watermark passes it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def drain_with_late(stream: DataFrame, ts: str, delay: str, target: str, late: str, checkpoint: str) -> None:
    """Append all available rows, those behind the watermark to ``late`` instead of dropping them.

    The watermark of a batch is the latest time of all batches before it, less ``delay`` (an interval). Each batch is
    judged as a whole and writes its rows, and the latest time so far, to folders of its own number: a batch that died
    is written again in its place, and a restart goes on from the times that are stored. Rows without a time are never late.
    """
    marks = f"{checkpoint}/latest"

    def settle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _latest(spark, marks, number - 1)
        border = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
        behind = F.coalesce(F.col(ts).cast("timestamp") < border, F.lit(False))
        batch.where(~behind).write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.where(behind).write.mode("overwrite").parquet(f"{late}/batch={number}")
        seen = batch.agg(F.max(F.col(ts).cast("timestamp")).alias("own"))
        latest = F.greatest("own", F.lit(before).cast("timestamp"))
        seen.select(F.date_format(latest, _TIME).alias("value")).na.fill("").coalesce(1).write.mode("overwrite").text(f"{marks}/batch={number}")

    query = stream.writeStream.foreachBatch(settle).option("checkpointLocation", f"{checkpoint}/query").trigger(availableNow=True).start()
    query.awaitTermination()


_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _latest(spark: SparkSession, marks: str, number: int) -> str | None:
    """Latest time of all batches up to ``number``, as text."""
    if number < 0:
        return None
    row = spark.read.text(f"{marks}/batch={number}").first()
    return row["value"] or None if row else None
