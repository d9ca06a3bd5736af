"""Outlier rules: rolling quartile fence for series, percentile band for tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import HALO, TIE, exact_quantiles, with_halo


def ts_outliers(
    df: DataFrame,
    column: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    window_size: int = 7,
    k: float = 7.5,
    **limits,
) -> DataFrame:
    """Flag increases above Q3 + k IQR of the last ``window_size`` increases.

    The increase is the change from the previous row, 0 on the first row. Adds
    ``increase_<column>`` and ``is_outlier_<column>``.
    """
    increase, flag = f"increase_{column}", f"is_outlier_{column}"
    # A frame of w increases needs the w values before the row.
    padded, group = with_halo(df, by, order, window_size, **limits)
    ordered = Window.partitionBy(*group).orderBy(*order, TIE)
    step = padded.withColumn(
        increase, F.coalesce(F.col(column) - F.lag(column).over(ordered), F.lit(0.0))
    )
    frame = ordered.rowsBetween(-(window_size - 1), 0)
    # Frames are tiny, so this accuracy makes the percentile the exact discrete one.
    quartiles = F.percentile_approx(increase, [0.25, 0.75], 100).over(frame)
    fenced = step.withColumn("__q", quartiles)
    fence = F.col("__q")[1] + F.lit(float(k)) * (F.col("__q")[1] - F.col("__q")[0])
    return (
        fenced.where(~F.col(HALO)).select(*df.columns, increase, (F.col(increase) > fence).alias(flag))
    )


def attach_outlier_flags(df: DataFrame, flags: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join of flag columns computed elsewhere. If ``flags`` repeats a key, the smallest flags count."""
    rest = [c for c in flags.columns if c not in key]
    once = flags.groupBy(*key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__flags"))
    return df.join(once.select(*key, "__flags.*"), list(key), "left")


def trim_outliers(
    df: DataFrame,
    column: str,
    lower: float = 0.05,
    upper: float = 0.95,
    max_null_ratio: float = 0.1,
    before: DataFrame | None = None,
    approximate: bool = False,
    **limits,
) -> DataFrame:
    """Keep the percentile band (inclusive) if few enough values are missing."""
    return split_outliers(df, column, lower, upper, max_null_ratio, before, approximate, **limits)[0]


def split_outliers(
    df: DataFrame,
    column: str,
    lower: float = 0.05,
    upper: float = 0.95,
    max_null_ratio: float = 0.1,
    before: DataFrame | None = None,
    approximate: bool = False,
    **limits,
) -> tuple[DataFrame, DataFrame]:
    """The rows inside the percentile band and those outside.

    The share of missing values is taken from ``before``, the table as it was
    ahead of other constraints; the percentiles come from ``df``.
    """
    source = df if before is None else before
    missing = source.agg(F.coalesce(F.avg(F.col(column).isNull().cast("int")), F.lit(0.0)).alias("m")).scalar()
    if approximate:
        band = df.agg(
            F.percentile_approx(column, F.lit(lower), 10_000).alias("low"),
            F.percentile_approx(column, F.lit(upper), 10_000).alias("high"),
        )
    else:
        numbers = df.where(~F.isnan(F.col(column).cast("double")))  # NaN has no place in an order
        band = exact_quantiles(numbers, column, [lower, upper], names=["low", "high"], **limits)
    limits_row = band.select(F.struct("low", "high").alias("b")).scalar()
    inside = F.col(column).between(limits_row.getField("low"), limits_row.getField("high"))
    keep = F.coalesce((missing > max_null_ratio) | inside, F.lit(False))
    return df.where(keep), df.where(~keep)
