"""The numbers behind the charts: top groups, pivots, shares, trend, box, histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles, null_safe_join


def finite(value: Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), value)


def top_groups(df: DataFrame, group: str, value: str, k: int = 5) -> DataFrame:
    """Rows of the ``k`` groups with the largest sum; ties by name."""
    best = df.groupBy(group).agg(F.sum(value).alias("__s")).orderBy(F.desc("__s"), group).limit(k)
    return df.join(F.broadcast(best.select(group)), group, "left_semi")  # k rows


def pivot_filled(df: DataFrame, index: str, column: str, value: str, values: Sequence) -> DataFrame:
    """Wide table, 0 where a combination is absent. The values become columns, so they are given."""
    wide = df.groupBy(index).pivot(column, list(values)).agg(F.first(value))
    return wide.fillna(0, subset=[str(v) for v in values])


def group_share(df: DataFrame, by: Sequence[str], value: str, share: str = "share") -> DataFrame:
    """Share of each row in its group's sum, in percent."""
    sums = df.groupBy(*by).agg(F.sum(value).alias("__s"))
    joined = null_safe_join(df, sums, list(by), "inner")
    return joined.select(*df.columns, (100.0 * F.col(value) / F.col("__s")).alias(share))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``; NULLs unless there are two rows."""
    both = df.where(finite(F.col(x)).isNotNull() & finite(F.col(y)).isNotNull())
    enough = F.count(F.lit(1)) > 1
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.when(enough, F.regr_slope(y, x)).alias("slope"),
        F.when(enough, F.regr_intercept(y, x)).alias("intercept"),
        F.when(enough, F.regr_r2(y, x)).alias("r2"),
    )


def _fences(df: DataFrame, by: str, value: str, limits: dict) -> DataFrame:
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75], [by], interpolate=True, names=["q1", "median", "q3"], **limits)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return quartiles.select("*", (F.col("q1") - reach).alias("__lo"), (F.col("q3") + reach).alias("__hi"))


def box_stats(df: DataFrame, by: str, value: str, **limits) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and number of outliers per group.

    Only the histogram of (group, value) meets the fences, not the rows.
    """
    inside = F.col(value).between(F.col("__lo"), F.col("__hi"))
    numbers = df.where(finite(F.col(value)).isNotNull())
    counts = numbers.groupBy(by, value).agg(F.count(F.lit(1)).alias("__n"))
    return (
        null_safe_join(counts, _fences(numbers, by, value, limits), [by], "inner")
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.least("q1", F.min(F.when(inside, F.col(value)))).alias("whisker_low"),
            F.greatest("q3", F.max(F.when(inside, F.col(value)))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("__n"))), F.lit(0)).alias("outliers"),
            F.sum("__n").alias("n"),
        )
    )


def box_outliers(df: DataFrame, by: str, value: str, **limits) -> DataFrame:
    """The points drawn outside the whiskers."""
    numbers = df.where(finite(F.col(value)).isNotNull())
    fenced = null_safe_join(numbers, _fences(numbers, by, value, limits), [by], "inner")
    return fenced.where(~F.col(value).between(F.col("__lo"), F.col("__hi"))).select(*df.columns)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the range, last one closed; empty bins are listed.

    A single value gets the range half a unit around it. NaN and infinite
    values are left out like missing ones.
    """
    v = finite(F.col(value).cast("double"))
    low, high = F.min(v), F.max(v)
    span = df.agg(
        F.struct(
            F.when(low == high, low - 0.5).otherwise(low).alias("low"),
            F.when(low == high, high + 0.5).otherwise(high).alias("high"),
        ).alias("s")
    ).scalar()
    start, end = span.getField("low"), span.getField("high")
    width = (end - start) / bins
    slot = F.least(F.floor((v - start) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("bin_low"),
        (start + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
