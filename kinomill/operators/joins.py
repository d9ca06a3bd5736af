"""Joins between sources. Spark and AQE choose the strategy from measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_left(df: DataFrame, links: DataFrame, key: str, links_key: str) -> DataFrame:
    """Left join on keys of different types, compared as text."""
    return df.join(links, df[key].cast("string") == links[links_key].cast("string"), "left")


def having_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    # Distinct first: a key that fills the right side is one row per task before it is shuffled.
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def without_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def pairs_on(left: DataFrame, right: DataFrame, on: Sequence[str], differ: tuple[str, str]) -> DataFrame:
    """Equi-join with an inequality on the side: the two sides of an edge differ."""
    return left.join(right, list(on)).where(F.col(differ[0]) != F.col(differ[1]))
