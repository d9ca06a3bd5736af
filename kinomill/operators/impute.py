"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ..functions.text import string_columns
from .ordered import exact_quantiles, neighbours
from .quality import numeric_columns

_AT = "__at"


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    raise TypeError(f"cannot measure distances on {column}")


def _fill_between(df, order, columns, by, mode, fallback, limits):
    placed = df.withColumn(_AT, _as_number(df, order[0]) if mode == "linear" else F.lit(0.0))
    found = neighbours(placed, by, order, columns, position=_AT, **limits)

    def filled(c):
        prev, nxt = F.col(f"__prev_{c}.value"), F.col(f"__next_{c}.value")
        middle = (prev + nxt) / 2
        if mode == "linear":
            start, end = F.col(f"__prev_{c}.at"), F.col(f"__next_{c}.at")
            share = (F.col(_AT) - start) / F.when(end > start, end - start)
            between = F.coalesce(prev + (nxt - prev) * share, middle)
        else:
            between = middle
        choices = [F.col(c), between, prev, nxt]
        if fallback is not None:
            choices.append(F.lit(fallback).cast(df.schema[c].dataType))
        return F.coalesce(*choices).alias(c)

    return found.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def impute_midpoint(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    mode: str = "midpoint",
    **limits,
) -> DataFrame:
    """Fill numeric gaps from the nearest values on both sides.

    ``midpoint`` takes their mean, ``linear`` weighs them by distance along the
    first order column. With one neighbour that one is used, with none NULL stays.
    """
    if mode not in ("midpoint", "linear"):
        raise ValueError(f"mode {mode!r} is neither midpoint nor linear")
    skip = {*order, *by}
    columns = list(columns or [c for c in numeric_columns(df) if c not in skip])
    return _fill_between(df, list(order), columns, by, mode, None, limits)


def impute_temporal(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = (), fallback=0, **limits
) -> DataFrame:
    """As ``impute_midpoint``; a series without any value gets ``fallback``.

    "Next" is the nearest later value, not the last one of the series.
    """
    return _fill_between(df, list(order), list(columns), by, "midpoint", fallback, limits)


def _unpivot(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def _fill_from_map(df: DataFrame, per_column: DataFrame, columns: Sequence[str], last: Column, keep_type: bool = False) -> DataFrame:
    """``per_column`` has one row per column name, so the map is small.

    ``keep_type`` casts the fill to the column's type instead of widening the column.
    """
    fills = per_column.agg(F.map_from_entries(F.collect_list(F.struct("column", "fill"))).alias("m")).scalar()
    chosen = set(columns)

    def filled(c):
        fill = F.coalesce(fills[F.lit(c)], last)
        return F.coalesce(F.col(f"`{c}`"), fill.cast(df.schema[c].dataType) if keep_type else fill).alias(c)

    return df.select(*[filled(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def column_modes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Most frequent value per column, NULL counted as a value; ties give the smallest value."""
    columns = list(columns or string_columns(df))
    counts = _unpivot(df, columns, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(-F.col("n"), F.col("value").isNull(), F.col("value"))
    return counts.groupBy("column").agg(F.min_by("value", rank).alias("fill"))


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None, unknown: str = "unknown") -> DataFrame:
    """Fill text columns with their mode, or ``unknown`` where NULL is the mode."""
    columns = list(columns or string_columns(df))
    if not columns:
        return df
    return _fill_from_map(df, column_modes(df, columns), columns, F.lit(unknown))


def impute_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    strategy: str = "median",
    default: float = 0.0,
    approximate: bool = False,
    **limits,
) -> DataFrame:
    """Fill numeric columns with their median (a value of the column, so the type stays) or mean (columns become double)."""
    if strategy not in ("median", "mean"):
        raise ValueError(f"strategy {strategy!r} is neither median nor mean")
    columns = list(columns or numeric_columns(df))
    if not columns:
        return df
    if strategy == "mean":
        fills = _unpivot(df, columns, "double").groupBy("column").agg(F.avg("value").alias("fill"))
        return _fill_from_map(df, fills, columns, F.lit(float(default)))
    # Columns of one type at a time, so that a median is a value of its column, beyond the integers of a double, too.
    kinds: dict = {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    filled = df
    for kind, same in kinds.items():
        long = _unpivot(df, same, kind)
        if approximate:
            fills = long.groupBy("column").agg(F.percentile_approx("value", F.lit(0.5), 10_000).alias("fill"))
        else:
            fills = exact_quantiles(long, "value", [0.5], by=["column"], names=["fill"], **limits)
        filled = _fill_from_map(filled, fills, same, F.lit(float(default)).cast(kind), keep_type=True)
    return filled
