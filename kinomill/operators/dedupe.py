"""Removing duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; copies are merged ahead of the shuffle."""
    return df.dropDuplicates()


def dedupe_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key, the first or last along ``order``.

    An aggregate rather than ``row_number``: each task sends one candidate per
    key, so a key with very many rows does not end up in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    keys = list(keys)
    pick = F.min_by if keep == "first" else F.max_by
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(pick(row, F.struct(*order)).alias("__row"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in df.columns])
