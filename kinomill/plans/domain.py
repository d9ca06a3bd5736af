"""The driver's tables seen as film tables.

Property tables follow set semantics (distinct), source-shaped tables keep one
row per fact and leave merging to the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import prefix_id
from ..sources.readers import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The largest table; most of the mapping work starts from it."""
    return spread(table(spark, folder, "lineitem"))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """The table of films. Its rows are short and few bytes, so millions are one split, and each gives a dozen statements."""
    return spread(table(spark, folder, "part"))


# Rows of a source table that one task maps to statements: each gives up to a dozen, which are merged in the task's memory.
ROWS_A_TASK = {"lineitem": 250_000, "part": 50_000}


def mapping_tasks(spark: SparkSession, folder: str, name: str) -> int | None:
    """Number of tasks that map a source table of the graph; None if its rows are few. Rows are counted by the files' footers.

    Rows of numbers are a few bytes, so tasks cut by bytes (splits, coalesced shuffles) would get millions of them.
    """
    source = "part" if name in ("movies", "title_basics") else "lineitem"
    tasks = -(-table(spark, folder, source).count() // ROWS_A_TASK[source])
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def movie_id(key: str) -> Column:
    return prefix_id(F.lpad(F.col(key).cast("string"), 7, "0"), "tt")


def person_id(key: str) -> Column:
    return prefix_id(F.lpad(F.col(key).cast("string"), 7, "0"), "nm")


def movie_title(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select(movie_id("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))


def movie_attr(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select(
        movie_id("p_partkey").alias("movie_id"), (F.lit(1950) + F.col("p_size")).alias("start_year")
    )


def movie_genre(spark, folder) -> DataFrame:
    genres = F.explode(F.array("p_type", "p_brand"))
    return table(spark, folder, "part").select(movie_id("p_partkey").alias("movie_id"), genres.alias("genre")).distinct()


def _gender() -> Column:
    code = F.col("s_nationkey") % 4
    return F.when(code == 1, "Female").when(code == 2, "Male").when(code == 3, "Non-binary").otherwise("NotSet")


def _profession() -> Column:
    code = F.col("s_suppkey") % 3
    return F.when(code == 0, "actor").when(code == 1, "director").otherwise("writer")


def person(spark, folder) -> DataFrame:
    return table(spark, folder, "supplier").select(
        person_id("s_suppkey").alias("person_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("popularity"),
        _gender().alias("gender"),
        _profession().alias("profession"),
    )


def _credits(spark, folder) -> DataFrame:
    return lines(spark, folder).where(F.col("l_linenumber").isin(1, 2))


def participates(spark, folder) -> DataFrame:
    return (
        _credits(spark, folder)
        .select("l_suppkey", "l_partkey", "l_linenumber")
        .distinct()
        .select(
            person_id("l_suppkey").alias("person_id"),
            movie_id("l_partkey").alias("movie_id"),
            F.when(F.col("l_linenumber") == 1, "director").otherwise("writer").alias("role"),
        )
    )


def known_for(spark, folder) -> DataFrame:
    return (
        _credits(spark, folder)
        .select("l_suppkey", "l_partkey")
        .distinct()
        .select(person_id("l_suppkey").alias("person_id"), movie_id("l_partkey").alias("movie_id"))
    )


def rating(spark, folder) -> DataFrame:
    scored = lines(spark, folder).select(
        "l_orderkey", "l_partkey", F.ceil(F.col("l_quantity") / 5).cast("int").alias("score")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        scored.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "l_partkey", "score")
        .distinct()
        .select(F.col("o_custkey").alias("user_id"), movie_id("l_partkey").alias("movie_id"), "score")
    )


# Source-shaped tables, as they leave the formatted or trusted zone.


def movies(spark, folder) -> DataFrame:
    return parts(spark, folder).select(
        movie_id("p_partkey").alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        F.array("p_type", "p_brand").alias("genres"),
    )


def title_basics(spark, folder) -> DataFrame:
    return parts(spark, folder).select(
        movie_id("p_partkey").alias("tconst"),
        F.lit("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        (F.col("p_partkey") % 17 == 0).alias("isAdult"),
        F.when(F.col("p_partkey") % 13 == 0, 1700).otherwise(1950 + F.col("p_size")).alias("startYear"),
        F.when(F.col("p_partkey") % 5 == 0, F.lit("1999")).when(F.col("p_partkey") % 11 == 0, F.lit("soon")).alias("endYear"),
        F.when(F.col("p_partkey") % 19 != 0, 60 + F.col("p_size")).alias("runtimeMinutes"),
        F.array("p_type", "p_brand").alias("genres"),
    )


def title_crew(spark, folder) -> DataFrame:
    """One row per credit line; the other list is empty."""
    empty = F.array().cast("array<string>")
    who = F.array(person_id("l_suppkey"))
    return _credits(spark, folder).select(
        movie_id("l_partkey").alias("tconst"),
        F.when(F.col("l_linenumber") == 1, who).otherwise(empty).alias("directors"),
        F.when(F.col("l_linenumber") == 2, who).otherwise(empty).alias("writers"),
    )


def name_basics(spark, folder) -> DataFrame:
    """One row per person and title the person is known for."""
    people = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.col("s_name").alias("primaryName"),
        (F.lit(1900) + F.col("s_nationkey")).alias("birthYear"),
        F.when(F.col("s_suppkey") % 2 == 0, 1890 + F.col("s_nationkey") * 2).alias("deathYear"),
        F.array(_profession(), F.when(F.col("s_nationkey") % 2 == 0, "producer").otherwise("editor")).alias(
            "primaryProfession"
        ),
    )
    works = _credits(spark, folder).select("l_suppkey", "l_partkey").distinct()
    return works.join(people, F.col("l_suppkey") == F.col("s_suppkey")).select(
        person_id("s_suppkey").alias("nconst"),
        "primaryName",
        "birthYear",
        "deathYear",
        "primaryProfession",
        F.array(movie_id("l_partkey")).alias("knownForTitles"),
    )


def crew_data(spark, folder) -> DataFrame:
    people = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal", _gender().alias("gender"))
    works = _credits(spark, folder).select("l_suppkey", "l_partkey", "l_quantity")
    return works.join(people, F.col("l_suppkey") == F.col("s_suppkey")).select(
        person_id("s_suppkey").alias("imdb_id"),
        F.col("s_suppkey").cast("int").alias("tmdb_id"),
        F.col("s_name").alias("name"),
        F.col("s_name").alias("original_name"),
        (F.col("s_suppkey") % 17 == 0).alias("adult"),
        F.col("s_acctbal").alias("popularity"),
        "gender",
        movie_id("l_partkey").alias("known_for"),
        F.col("l_quantity").alias("known_for_popularity"),
    )


def ratings(spark, folder) -> DataFrame:
    rated = lines(spark, folder).select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return rated.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        movie_id("l_partkey").alias("movie_id"),
        F.ceil(F.col("l_quantity") / 5).cast("int").alias("rating"),
        F.col("o_orderdate").alias("rating_timestamp"),
    )
