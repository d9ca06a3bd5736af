"""Raw source tables to the common data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import NA_MARKERS, NA_MARKERS_BACKSLASH, fold_accents, format_values, missing_if_marker, squeeze
from ..operators.joins import lookup_left

# Person gender codes.
GENDER_CODES = {0: "NotSet", 1: "Female", 2: "Male", 3: "Non-binary"}


def format_movies(raw: DataFrame) -> DataFrame:
    """``Name (YYYY)`` split up; ids prefixed; genres as array. Titles are folded first, so a no-break space is a space."""
    clean = format_values(raw.withColumn("movie_title", fold_accents(F.col("movie_title"))), NA_MARKERS)
    title = squeeze(S.strip_year(F.col("movie_title")))
    return clean.select(
        S.prefix_id(F.col("movie_id"), "tt").alias("movie_id"),
        missing_if_marker(title).alias("movie_title"),
        S.extract_year(F.col("movie_title")).alias("movie_year"),
        S.split_list(F.col("genres"), "|").alias("genres"),
    )


def format_users(raw: DataFrame) -> DataFrame:
    return format_values(raw, NA_MARKERS)


def format_ratings(raw: DataFrame) -> DataFrame:
    clean = format_values(raw, NA_MARKERS)
    return clean.select(
        "user_id",
        S.prefix_id(F.col("movie_id"), "tt").alias("movie_id"),
        S.to_int(F.col("rating")).alias("rating"),
        S.epoch_to_ts(F.col("rating_timestamp")).alias("rating_timestamp"),
    )


def format_title_basics(raw: DataFrame) -> DataFrame:
    folded = raw.withColumns({c: fold_accents(F.col(c)) for c in ("primaryTitle", "originalTitle")})
    clean = format_values(folded, NA_MARKERS_BACKSLASH)
    return clean.select(
        "tconst",
        "titleType",
        "primaryTitle",
        "originalTitle",
        S.int_to_bool(F.col("isAdult")).alias("isAdult"),
        "startYear",
        "endYear",
        "runtimeMinutes",
        S.split_list(F.col("genres"), ",").alias("genres"),
    )


def format_title_crew(raw: DataFrame) -> DataFrame:
    clean = format_values(raw, NA_MARKERS_BACKSLASH)
    return clean.select("tconst", *[S.split_list(F.col(c), ",").alias(c) for c in ("directors", "writers")])


def format_name_basics(raw: DataFrame) -> DataFrame:
    clean = format_values(raw, NA_MARKERS_BACKSLASH)
    return clean.select(
        "nconst",
        "primaryName",
        *[S.to_int(F.col(c)).alias(c) for c in ("birthYear", "deathYear")],
        *[S.split_list(F.col(c), ",").alias(c) for c in ("primaryProfession", "knownForTitles")],
    )


def format_crew_data(payload: DataFrame, links: DataFrame, keep_without_titles: bool = False) -> DataFrame:
    """Person payloads, one row per known-for title, title ids resolved through ``links``."""
    people = S.flatten(payload.select("value.imdb_id", "value.tmdb_data"), "tmdb_data")
    people = people.withColumnRenamed("id", "tmdb_id")
    works = S.unnest(people, "known_for", "work", keep_empty=keep_without_titles).select(
        "*", F.col("work.id").alias("work_id"), F.col("work.popularity").alias("known_for_popularity")
    )
    ids = links.select(S.prefix_id(F.col("imdbId"), "tt").alias("link_imdb"), F.col("tmdbId").alias("link_tmdb"))
    joined = lookup_left(works, ids, "work_id", "link_tmdb")
    shaped = joined.select(
        "imdb_id",
        "tmdb_id",
        "name",
        "original_name",
        "media_type",
        "adult",
        "popularity",
        S.decode(F.col("gender"), GENDER_CODES).alias("gender"),
        "known_for_department",
        "profile_path",
        S.resolve_id(F.col("link_imdb"), F.col("work_id")).alias("known_for"),
        "known_for_popularity",
    )
    folded = shaped.withColumns({c: fold_accents(F.col(c)) for c in ("name", "original_name")})
    return format_values(folded, NA_MARKERS)
