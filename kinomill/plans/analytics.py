"""The eight analytical queries over property tables.

Property tables are sets and may hold several values per entity. Ratings are
summed per movie before any join: the join then sees one row per movie, so a
movie with very many ratings is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import decade
from ..operators.joins import pairs_on
from ..operators.ordered import null_safe_join

def profession_gender(profession: DataFrame, gender: DataFrame) -> DataFrame:
    """(person_id, profession) x (person_id, gender) -> people per pair."""
    return (
        profession.join(gender, "person_id")
        .groupBy("profession", "gender")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def genre_by_decade(movie_year: DataFrame, movie_genre: DataFrame) -> DataFrame:
    """Movies per decade and genre, after 1900."""
    recent = movie_year.where(F.col("start_year") > 1900)
    return (
        recent.join(movie_genre, "movie_id")
        .groupBy(decade(F.col("start_year")).alias("decade"), "genre")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("decade", "genre")
    )


def _movie_scores(rating: DataFrame) -> DataFrame:
    return rating.groupBy("movie_id").agg(F.sum("score").alias("score_sum"), F.count(F.lit(1)).alias("score_count"))


def _mean_score():
    return F.sum("score_sum") / F.sum("score_count")


def collaborations(participates: DataFrame, names: DataFrame, k: int = 20) -> DataFrame:
    """Director and writer names that share most movies, two different people.

    Names that cannot reach the k best are left out before pairs are formed.
    """
    named = participates.join(names, "person_id")
    directors = named.where("role = 'director'").select(
        "movie_id", F.col("person_id").alias("director"), F.col("name").alias("director_name")
    )
    writers = named.where("role = 'writer'").select(
        "movie_id", F.col("person_id").alias("writer"), F.col("name").alias("writer_name")
    )
    directors, writers = _prune_names(directors, writers, k)
    return (
        pairs_on(directors, writers, ["movie_id"], ("director", "writer"))
        .groupBy("director_name", "writer_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "director_name", "writer_name")
        .limit(k)
    )


def _prune_names(directors: DataFrame, writers: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Leave out names that cannot reach the k best pairs; the result stays exact.

    A pair's count is at most the bound of either name: the sum over the name's
    credits of how often one name can occur on the other side of that movie. The
    k-th best count is at least the k-th best among pairs formed by taking, for
    each movie, only its strongest director and strongest writer.
    """

    def most_per_name(side, name):
        per_name = side.groupBy("movie_id", name).agg(F.count(F.lit(1)).alias("__c"))
        return per_name.groupBy("movie_id").agg(F.max("__c").alias("__most"))

    def bounds(side, name, other):
        return side.join(other, "movie_id").groupBy(name).agg(F.sum("__most").alias("__bound"))

    d_bound = bounds(directors, "director_name", most_per_name(writers, "writer_name"))
    w_bound = bounds(writers, "writer_name", most_per_name(directors, "director_name"))
    d_rated = null_safe_join(directors, d_bound, ["director_name"], "inner")
    w_rated = null_safe_join(writers, w_bound, ["writer_name"], "inner")

    def strongest(side, who, name, alias):
        rank = F.struct("__bound", name, who)
        return side.groupBy("movie_id").agg(F.max_by(F.struct(who, name), rank).alias(alias))

    stars = strongest(d_rated, "director", "director_name", "d").join(
        strongest(w_rated, "writer", "writer_name", "w"), "movie_id"
    )
    certain = (
        stars.where("d.director != w.writer")
        .groupBy("d.director_name", "w.writer_name")
        .agg(F.count(F.lit(1)).alias("c"))
        .orderBy(F.desc("c"))
        .limit(k)
    )
    floor = certain.agg(F.when(F.count(F.lit(1)) == k, F.min("c")).otherwise(0).alias("f")).scalar()
    return (
        d_rated.where(F.col("__bound") >= floor).drop("__bound"),
        w_rated.where(F.col("__bound") >= floor).drop("__bound"),
    )


def popularity_vs_rating(popularity: DataFrame, known_for: DataFrame, rating: DataFrame) -> DataFrame:
    """Popularity and mean rating of the movies a person is known for."""
    per_person = (
        known_for.join(_movie_scores(rating), "movie_id")
        .groupBy("person_id")
        .agg(_mean_score().alias("avg_rating"))
    )
    return per_person.join(popularity, "person_id").select("person_id", "popularity", "avg_rating")


def career_longevity(names: DataFrame, known_for: DataFrame, movie_year: DataFrame, more_than: int = 5, k: int = 20) -> DataFrame:
    """People with the longest span between known works."""
    spans = (
        known_for.join(movie_year, "movie_id")
        .groupBy("person_id")
        .agg(F.min("start_year").alias("debut"), F.max("start_year").alias("last_active"), F.count("start_year").alias("works"))
        .where(F.col("works") > more_than)
    )
    return (
        spans.join(names, "person_id")
        .select("person_id", "name", "debut", "last_active", (F.col("last_active") - F.col("debut")).alias("career_span"))
        .orderBy(F.desc("career_span"), "name", "person_id")
        .limit(k)
    )


def genre_rating(movie_genre: DataFrame, rating: DataFrame) -> DataFrame:
    return (
        movie_genre.join(_movie_scores(rating), "movie_id")
        .groupBy("genre")
        .agg(_mean_score().alias("avg_rating"))
        .orderBy(F.desc("avg_rating"), "genre")
    )


def top_rated(movie_title: DataFrame, movie_genre: DataFrame, rating: DataFrame, at_least: int = 10, k: int = 20) -> DataFrame:
    """Best (title, genre) pairs by mean rating; titles group by text."""
    return (
        _movie_scores(rating)
        .join(movie_title, "movie_id")
        .join(movie_genre, "movie_id")
        .groupBy("title", "genre")
        .agg(_mean_score().alias("avg_rating"), F.sum("score_count").alias("rating_count"))
        .where(F.col("rating_count") >= at_least)
        .orderBy(F.desc("avg_rating"), "title", "genre")
        .limit(k)
    )


def popularity_distribution(popularity: DataFrame, profession: DataFrame) -> DataFrame:
    return (
        popularity.where(F.col("popularity") > 0).join(profession, "person_id").select("profession", "popularity")
    )
