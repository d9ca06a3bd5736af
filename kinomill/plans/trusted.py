"""Formatted tables to trusted ones: preparation, rules, outlier band, duplicates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import constraints as C
from ..operators import quality
from ..operators.dedupe import dedupe_rows
from ..operators.outliers import split_outliers

FIRST_YEAR = 1800


@dataclass(frozen=True)
class Treatment:
    """What makes one dataset trusted."""

    rules: Callable[..., list[C.Rule]]
    arrays: tuple[str, ...] = ()
    drops: tuple[str, ...] = ()
    band: str | None = None
    timestamps: tuple[str, ...] = ()
    dedupe: bool = False
    defaults: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Trusted:
    clean: DataFrame
    violations: DataFrame
    metrics: DataFrame


def _last_year(as_of):
    return F.year(F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"))


def title_rules(as_of=None, **_):
    last = _last_year(as_of)
    return [
        C.in_range("runtimeMinutes", 0, None),
        C.in_domain("isAdult", [False, True]),
        C.in_range("startYear", FIRST_YEAR, last),
        C.in_range("endYear", FIRST_YEAR, last, optional=True, value=S.to_int(F.col("endYear"))),
    ]


def crew_rules(null_arrays="drop", **_):
    return [
        C.not_null("tconst"),
        C.has_prefix("tconst", "tt"),
        C.all_have_prefix("directors", "nm", null_arrays),
        C.all_have_prefix("writers", "nm", null_arrays),
        C.any_elements("directors", "writers", null_arrays=null_arrays),
    ]


def name_rules(as_of=None, null_arrays="drop", **_):
    last = _last_year(as_of)
    return [
        C.not_null("nconst"),
        C.has_prefix("nconst", "nm"),
        C.in_range("birthYear", FIRST_YEAR, last, optional=True),
        C.in_range("deathYear", FIRST_YEAR, last, optional=True),
        C.in_order("birthYear", "deathYear"),
        C.all_have_prefix("knownForTitles", "tt", null_arrays),
    ]


def movie_rules(**_):
    return [C.not_null("movie_id"), C.has_prefix("movie_id", "tt")]


def user_rules(**_):
    return [C.not_null("user_id", "twitter_id")]


def rating_rules(**_):
    return [C.not_null("user_id", "movie_id"), C.in_range("rating", 0, 10)]


def person_rules(**_):
    return [
        C.not_null("imdb_id", "tmdb_id"),
        C.has_prefix("imdb_id", "nm"),
        C.in_range("popularity", 0, None),
        C.in_range("known_for_popularity", 0, None),
        C.in_domain("gender", ["Female", "Male", "Non-binary"]),
        C.in_domain("adult", [True, False]),
        C.has_prefix("known_for", "tt"),
    ]


TREATMENTS = {
    "title_basics": Treatment(title_rules, drops=("originalTitle",)),
    "title_crew": Treatment(crew_rules, arrays=("directors", "writers")),
    "name_basics": Treatment(name_rules, arrays=("knownForTitles",)),
    "movies": Treatment(movie_rules, drops=("movie_year",), dedupe=True),
    "users": Treatment(user_rules, dedupe=True),
    "ratings": Treatment(rating_rules, timestamps=("rating_timestamp",), dedupe=True),
    "crew_data": Treatment(person_rules, drops=("original_name",), band="popularity", dedupe=True),
}


def prepare(df: DataFrame, treatment: Treatment) -> DataFrame:
    """Drop empty array elements ahead of the rules."""
    arrays = {c: S.clean_array(F.col(c)) for c in treatment.arrays}
    return df.withColumns(arrays) if arrays else df


def metrics(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Profile, completeness and redundancy as (metric, column, value) rows, in two passes.

    Exact distinct counts multiply the rows by the number of columns; ``approximate`` uses sketches.
    """
    profiled = quality.profile(df, approximate).withColumn("missing_ratio", 1 - F.col("value_count") / F.when(F.col("row_count") > 0, F.col("row_count")))
    measures = ("distinct_count", "value_count", "missing_ratio", "mean", "stddev", "min", "max")
    per_column = profiled.select("column", _long(measures)).where("value is not null")
    whole = quality.whole_rows(df).select(F.lit(None).cast("string").alias("column"), _long(("complete_ratio", "redundancy_factor")))
    return per_column.unionByName(whole)


def _long(measures):
    return F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures]))


def trust(
    df: DataFrame,
    dataset: str | Treatment,
    as_of: date | str | None = None,
    null_arrays: str = "drop",
    dedupe: bool | None = None,
    approximate: bool = False,
    **limits,
) -> Trusted:
    """Clean rows, rows that failed with the rules they failed, and metrics of the input."""
    treatment = TREATMENTS[dataset] if isinstance(dataset, str) else dataset
    rules = treatment.rules(as_of=as_of, null_arrays=null_arrays)
    ready = prepare(df, treatment)
    clean = C.apply_constraints(ready, rules)
    failed = C.violations(ready, rules)
    if treatment.band:
        kept, cut = split_outliers(clean, treatment.band, before=df, approximate=approximate, **limits)
        reason = F.array(F.lit(f"in_band({treatment.band})"))
        clean, failed = kept, failed.unionByName(cut.withColumn("violated", reason))
    clean = S.drop_if_exists(clean, *treatment.drops)
    if treatment.timestamps:
        clean = clean.withColumns({c: S.canonical_ts(F.col(c)) for c in treatment.timestamps})
    if treatment.dedupe if dedupe is None else dedupe:
        clean = dedupe_rows(clean)
    return Trusted(clean, failed, metrics(df, approximate))
