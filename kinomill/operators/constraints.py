"""Row constraints as data: named boolean columns that filter and explain."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row passes if ``test`` is true; false and NULL both fail."""

    name: str
    test: Column


def not_null(*columns: str) -> Rule:
    return Rule("not_null(" + ",".join(columns) + ")", _all(F.col(c).isNotNull() for c in columns))


def has_prefix(column: str, prefix: str) -> Rule:
    return Rule(f"has_prefix({column},{prefix})", F.col(column).startswith(prefix))


def in_range(column: str, low, high, optional: bool = False, value: Column | None = None) -> Rule:
    """``low <= column <= high``, ends may be None; ``optional`` lets NULL pass."""
    number = F.col(column) if value is None else value
    tests = [number >= low] if low is not None else []
    tests += [number <= high] if high is not None else []
    inside = _all(tests)
    return Rule(f"in_range({column})", F.col(column).isNull() | inside if optional else inside)


def in_domain(column: str, values: Sequence) -> Rule:
    return Rule(f"in_domain({column})", F.col(column).isin(list(values)))


def in_order(first: str, second: str) -> Rule:
    """``first <= second`` where both are known."""
    test = F.col(first).isNull() | F.col(second).isNull() | (F.col(first) <= F.col(second))
    return Rule(f"in_order({first},{second})", test)


def all_have_prefix(column: str, prefix: str, null_arrays: str = "drop") -> Rule:
    """Every element starts with ``prefix``; an empty array passes.

    A NULL array fails, or counts as empty with ``null_arrays="empty"``.
    """
    return Rule(f"all_have_prefix({column},{prefix})", F.forall(_array(column, null_arrays), lambda x: x.startswith(prefix)))


def any_elements(*columns: str, null_arrays: str = "drop") -> Rule:
    """At least one of the arrays has an element."""
    filled = reduce(lambda a, b: a | b, [F.size(_array(c, null_arrays)) > 0 for c in columns])
    return Rule("any_elements(" + ",".join(columns) + ")", filled)


def _array(column: str, null_arrays: str) -> Column:
    if null_arrays not in ("drop", "empty"):
        raise ValueError("null_arrays is 'drop' or 'empty'")
    c = F.col(column)
    return c if null_arrays == "drop" else F.coalesce(c, F.array().cast("array<string>"))


def _all(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def apply_constraints(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass all rules. Plain predicates, so they reach the scan."""
    return df.where(_all(r.test for r in rules))


def violations(df: DataFrame, rules: Sequence[Rule], column: str = "violated") -> DataFrame:
    """Rows that fail, with the names of the failed rules."""
    names = F.array_compact(F.array(*[F.when(~F.coalesce(r.test, F.lit(False)), F.lit(r.name)) for r in rules]))
    return df.withColumn(column, names).where(F.size(column) > 0)


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: how many rows fail it."""
    if not rules:
        raise ValueError("no rules given")
    failed = [
        F.struct(
            F.lit(r.name).alias("rule"), F.count_if(~F.coalesce(r.test, F.lit(False))).alias("violations")
        )
        for r in rules
    ]
    return df.agg(F.array(*failed).alias("__v")).select(F.inline("__v"))
