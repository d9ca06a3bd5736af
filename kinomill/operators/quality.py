"""Profiling and quality metrics. Each metric is one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: row count, distinct values (NULL is one), missing, numeric summary.

    Exact distinct counts shuffle each column's distinct values; ``approximate``
    keeps the pass to fixed-size sketches.
    """
    numbers = set(numeric_columns(df))
    rows = F.count(F.lit(1))
    parts = []
    for field in df.schema.fields:
        c = _quoted(field.name)
        comparable = c.cast("string") if isinstance(field.dataType, MapType) else c
        distinct = F.approx_count_distinct(comparable) if approximate else F.count_distinct(comparable)
        has_null = F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
        numeric = field.name in numbers
        absent = F.lit(None).cast("double")
        parts.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                rows.alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
                (distinct + has_null).alias("distinct_count"),
                F.count(c).alias("value_count"),
                (F.avg(c).cast("double") if numeric else absent).alias("mean"),
                (F.stddev_samp(c) if numeric else absent).alias("stddev"),
                (F.min(c).cast("double") if numeric else absent).alias("min"),
                (F.max(c).cast("double") if numeric else absent).alias("max"),
            )
        )
    return df.agg(F.array(*parts).alias("__p")).select(F.inline("__p"))


def column_completeness(df: DataFrame) -> DataFrame:
    """Share of missing values per column; no rows for an empty input."""
    parts = [
        F.struct(F.lit(c).alias("column"), F.avg(_quoted(c).isNull().cast("int")).alias("missing_ratio"))
        for c in df.columns
    ]
    return df.agg(F.array(*parts).alias("__p")).select(F.inline("__p")).where("missing_ratio is not null")


def complete_row(df: DataFrame) -> Column:
    test = F.lit(True)
    for c in df.columns:
        test = test & _quoted(c).isNotNull()
    return test


def relation_completeness(df: DataFrame) -> DataFrame:
    """Share of rows without any missing value; 0 for an empty input."""
    return df.agg(F.coalesce(F.avg(complete_row(df).cast("double")), F.lit(0.0)).alias("complete_ratio"))


def whole_rows(df: DataFrame) -> DataFrame:
    """Redundancy and completeness of whole rows in one pass.

    Copies are merged before the shuffle, so a row repeated very often is cheap.
    """
    per_row = df.groupBy(*[_quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    rows, distinct = F.sum("__n"), F.count(F.lit(1))
    complete = F.sum(F.when(complete_row(df), F.col("__n")).otherwise(0))
    return per_row.agg(
        F.coalesce(rows, F.lit(0)).alias("row_count"),
        distinct.alias("distinct_rows"),
        (rows / F.when(distinct > 0, distinct)).alias("redundancy_factor"),
        F.coalesce(complete / F.when(rows > 0, rows), F.lit(0.0)).alias("complete_ratio"),
    )


def redundancy(df: DataFrame) -> DataFrame:
    """Rows over distinct rows (1 = no duplicates); NULL for an empty input."""
    return whole_rows(df).select("row_count", "distinct_rows", "redundancy_factor")


def timeliness(
    df: DataFrame, attribute: str, ts_column: str, update_rate: float = 12, as_of: date | str | None = None
) -> DataFrame:
    """Mean of 1 / (1 + age in days x update rate)."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    age = F.date_diff(today, F.col(ts_column).try_cast("date")) + F.lit(1e-9)
    score = 1 / (1 + age * F.lit(float(update_rate)))
    return df.agg(F.lit(attribute).alias("attribute"), F.avg(score).alias("timeliness_score"))


def _calendar(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    days = df.select(F.col(column).try_cast("date").alias("day")).where("day is not null").distinct()
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    every = span.where("first is not null").select(F.explode(F.sequence("first", "last")).alias("day"))
    return days, every


def missing_dates(df: DataFrame, column: str) -> DataFrame:
    """Days between the first and the last one that have no row."""
    days, every = _calendar(df, column)
    return every.join(days, "day", "left_anti")


def date_coverage(df: DataFrame, column: str) -> DataFrame:
    """Every day of the range with a flag whether the data has it."""
    days, every = _calendar(df, column)
    return every.join(days.withColumn("present", F.lit(True)), "day", "left").select(
        "day", F.coalesce("present", F.lit(False)).alias("present")
    )


def is_complete_calendar(df: DataFrame, column: str) -> DataFrame:
    days = df.select(F.col(column).try_cast("date").alias("day")).where("day is not null").distinct()
    span = F.date_diff(F.max("day"), F.min("day")) + 1
    return days.agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days_present"),
        (span - F.count(F.lit(1))).alias("days_missing"),
        (span == F.count(F.lit(1))).alias("is_complete"),
    )


def report(profiled: DataFrame) -> str:
    """Printable text of a ``profile`` result (one line per column)."""
    rows = sorted(profiled.collect(), key=lambda r: r["column"])
    if not rows:
        return "no columns"
    head = f"rows: {rows[0]['row_count']}  columns: {rows[0]['column_count']}"
    lines = [head, f"{'column':<28}{'distinct':>12}{'count':>12}{'mean':>14}{'stddev':>14}{'min':>14}{'max':>14}"]
    for r in rows:
        figures = "".join(f"{'' if r[k] is None else format(r[k], '.2f'):>14}" for k in ("mean", "stddev", "min", "max"))
        lines.append(f"{r['column']:<28}{r['distinct_count']:>12}{r['value_count']:>12}{figures}")
    return "\n".join(lines)


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n): the different values of each column as text and how often they occur, NULL among them."""
    names = list(columns or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
