"""Registered queries: the chain from raw tables to the eight queries, and its steps per dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import chain
from ..plans import domain as D
from ..session import scratch_path
from .views import movie, person, with_views

AS_OF = "2024-06-30"


def _text(column):
    return F.coalesce(F.col(column).cast("string"), F.lit("\\N"))


def _raw_titles(spark, d):
    return D.title_basics(spark, d).select(
        "tconst", "titleType", F.concat(F.lit("  "), "primaryTitle").alias("primaryTitle"), "originalTitle",
        F.col("isAdult").cast("int").alias("isAdult"), "startYear", _text("endYear").alias("endYear"), "runtimeMinutes",
        F.array_join("genres", ",").alias("genres"),
    )


def _raw_crew(spark, d):
    """One row per title with its people in two lists, as the source has it."""
    people = [F.array_join(F.array_sort(F.collect_set(F.get(c, F.lit(0)))), ",").alias(c) for c in ("directors", "writers")]
    return D.title_crew(spark, d).groupBy("tconst").agg(*people)


def _raw_names(spark, d):
    return D.name_basics(spark, d).select(
        "nconst", "primaryName", *[_text(c).alias(c) for c in ("birthYear", "deathYear")],
        *[F.array_join(c, ",").alias(c) for c in ("primaryProfession", "knownForTitles")],
    )


def _raw_movies(spark, d):
    return D.movies(spark, d).select(
        F.substring("movie_id", 3, 20).alias("movie_id"),
        F.concat("movie_title", F.lit(" (1999)")).alias("movie_title"),
        F.array_join("genres", "|").alias("genres"),
    )


def _raw_users(spark, d):
    key = F.col("c_custkey")
    return D.table(spark, d, "customer").select(
        key.cast("string").alias("user_id"), F.when(key % 4 == 0, "N/A").otherwise(F.concat(F.lit(" t"), key.cast("string"))).alias("twitter_id")
    )


def _raw_ratings(spark, d):
    return D.ratings(spark, d).select(
        "user_id",
        F.substring("movie_id", 3, 20).alias("movie_id"),
        F.col("rating").cast("string").alias("rating"),
        F.unix_seconds(F.col("rating_timestamp").cast("timestamp")).cast("string").alias("rating_timestamp"),
    )


def _raw_people(spark, d):
    """Payloads with one known work each, and the links that give works their ids."""
    work = F.struct(F.col("known_for").substr(3, 20).cast("int").alias("id"), F.col("known_for_popularity").alias("popularity"))
    codes = F.create_map(*[F.lit(x) for pair in (("NotSet", 0), ("Female", 1), ("Male", 2), ("Non-binary", 3)) for x in pair])
    body = F.struct(
        F.col("tmdb_id").alias("id"), "name", "original_name", F.lit("person").alias("media_type"), "adult", "popularity",
        codes[F.col("gender")].alias("gender"), F.lit("Acting").alias("known_for_department"), F.lit("/p").alias("profile_path"),
        F.array(work).alias("known_for"),
    )
    people = D.crew_data(spark, d).select("imdb_id", F.struct("imdb_id", body.alias("tmdb_data")).alias("value"))
    links = D.table(spark, d, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("imdbId"),
        F.col("p_partkey").cast("string").alias("tmdbId"),
    )
    return people, links


def _raw(spark, d):
    people, links = _raw_people(spark, d)
    return {
        "title_basics": _raw_titles(spark, d),
        "title_crew": _raw_crew(spark, d),
        "name_basics": _raw_names(spark, d),
        "movies": _raw_movies(spark, d),
        "users": _raw_users(spark, d),
        "ratings": _raw_ratings(spark, d),
        "people": people,
        "links": links,
    }


def _analyses(spark, d):
    """The chain over a folder, with a graph of its own."""
    return chain.run(spark, _raw(spark, d), scratch_path(spark, "chain"), AS_OF)


def pipeline_q1(spark, d):
    return _analyses(spark, d).profession_gender()


def pipeline_q2(spark, d):
    return _analyses(spark, d).genre_by_decade()


def pipeline_q3(spark, d):
    return _analyses(spark, d).collaborations()


def pipeline_q4(spark, d):
    return _analyses(spark, d).popularity_vs_rating().withColumn("avg_rating", F.round("avg_rating", 6))


def pipeline_q5(spark, d):
    return _analyses(spark, d).career_longevity()


def pipeline_q6(spark, d):
    return _analyses(spark, d).genre_rating().withColumn("avg_rating", F.round("avg_rating", 6))


def pipeline_q7(spark, d):
    return _analyses(spark, d).top_rated().withColumn("avg_rating", F.round("avg_rating", 6))


def pipeline_q8(spark, d):
    return _analyses(spark, d).popularity_distribution()


def _joined(df, *arrays):
    return df.withColumns({c: F.array_join(c, "|") for c in arrays})


def format_movies(spark, d):
    return _joined(chain.FORMATS["movies"](_raw_movies(spark, d)), "genres")


def format_users(spark, d):
    return chain.FORMATS["users"](_raw_users(spark, d))


def format_title_crew(spark, d):
    return _joined(chain.FORMATS["title_crew"](_raw_crew(spark, d)), "directors", "writers")


def format_name_basics(spark, d):
    return _joined(chain.FORMATS["name_basics"](_raw_names(spark, d)), "primaryProfession", "knownForTitles")


def _trusted(spark, d, name, raw):
    return chain.trust_all(chain.format_all({name: raw(spark, d)}), AS_OF)[name].clean


def trust_title_basics(spark, d):
    return _joined(_trusted(spark, d, "title_basics", _raw_titles), "genres")


def trust_title_crew(spark, d):
    return _joined(_trusted(spark, d, "title_crew", _raw_crew), "directors", "writers")


def trust_name_basics(spark, d):
    return _joined(_trusted(spark, d, "name_basics", _raw_names), "primaryProfession", "knownForTitles")


def trust_movies(spark, d):
    return _joined(_trusted(spark, d, "movies", _raw_movies), "genres")


def trust_users(spark, d):
    return _trusted(spark, d, "users", _raw_users)


QUERIES = {
    f.__name__: f
    for f in (
        format_movies, format_users, format_title_crew, format_name_basics, trust_title_basics, trust_title_crew,
        trust_name_basics, trust_movies, trust_users, pipeline_q1, pipeline_q2, pipeline_q3, pipeline_q4, pipeline_q5,
        pipeline_q6, pipeline_q7, pipeline_q8,
    )
}

_CREW_FIELDS = (
    f"select {movie('l_partkey')} as tconst, "
    + ", ".join(
        f"string_agg(distinct {person('l_suppkey')}, '|' order by {person('l_suppkey')}) filter (where l_linenumber = {n}) as {c}"
        for n, c in ((1, "directors"), (2, "writers"))
    )
    + " from lineitem where l_linenumber in (1, 2) group by 1"
)
_NAME_FIELDS = (
    'select nconst, primary_name as "primaryName", birth_year as "birthYear", death_year as "deathYear", '
    "job0 || '|' || job1 as \"primaryProfession\", title as \"knownForTitles\" from name_basics"
)
_TITLE_OK = "start_year >= 1800 and runtime is not null and coalesce(end_year, '') <> 'soon'"
_NAME_OK = "(death_year is null or birth_year <= death_year)"
_PERSON_OK = "popularity >= 0 and gender <> 'NotSet'"
_BAND = (
    f"popularity between (select quantile_disc(popularity, 0.05) from crew_data where {_PERSON_OK}) "
    f"and (select quantile_disc(popularity, 0.95) from crew_data where {_PERSON_OK})"
)


def _over(body):
    """``body`` over what the trusted tables say, as sets."""
    views = (
        f"title_ok as (select tconst as movie_id, start_year from title_basics where {_TITLE_OK}), "
        f"name_ok as (select * from name_basics where {_NAME_OK}), "
        f"crew_ok as (select * from crew_data where {_PERSON_OK} and {_BAND}), "
        "job as (select distinct nconst as person_id, job0 as profession from name_ok), "
        "sex as (select distinct imdb_id as person_id, gender from crew_ok), "
        "pop as (select distinct imdb_id as person_id, popularity from crew_ok), "
        "named as (select nconst as person_id, primary_name as name from name_ok union select imdb_id, name from crew_ok), "
        "known as (select nconst as person_id, title as movie_id from name_ok union select imdb_id, known_for from crew_ok) "
    )
    names = ("title_basics", "name_basics", "crew_data", "movie_genre", "movie_title", "rating", "participates")
    start = with_views("", *names).rstrip()
    return f"{start}, {views}{body}"


ORACLE = {
    "format_movies": f"select {movie('p_partkey')} as movie_id, p_name as movie_title, 1999 as movie_year, p_type || '|' || p_brand as genres from part",
    "format_users": "select cast(c_custkey as varchar) as user_id, case when c_custkey % 4 <> 0 then 't' || cast(c_custkey as varchar) end as twitter_id from customer",
    "format_title_crew": _CREW_FIELDS,
    "format_name_basics": with_views(_NAME_FIELDS, "name_basics"),
    "trust_title_basics": with_views(
        'select tconst, title_type as "titleType", primary_title as "primaryTitle", is_adult as "isAdult", start_year as "startYear", '
        'end_year as "endYear", runtime as "runtimeMinutes", p_type || \'|\' || p_brand as genres from title_basics '
        f"where {_TITLE_OK}",
        "title_basics",
    ),
    # An empty list is missing after formatting, and a missing list fails the rules.
    "trust_title_crew": f"select * from ({_CREW_FIELDS}) x where directors is not null and writers is not null",
    "trust_name_basics": with_views(f"{_NAME_FIELDS} where {_NAME_OK}", "name_basics"),
    "trust_movies": f"select {movie('p_partkey')} as movie_id, p_name as movie_title, p_type || '|' || p_brand as genres from part",
    "trust_users": "select cast(c_custkey as varchar) as user_id, 't' || cast(c_custkey as varchar) as twitter_id from customer where c_custkey % 4 <> 0",
    "pipeline_q1": _over("select profession, gender, count(*) as n from job join sex using (person_id) group by 1, 2"),
    "pipeline_q2": _over(
        "select cast(floor(start_year / 10) * 10 as bigint) as decade, genre, count(*) as n from title_ok join movie_genre using (movie_id) "
        "where start_year > 1900 group by 1, 2"
    ),
    "pipeline_q3": _over(
        "select dn.name as director_name, wn.name as writer_name, count(*) as n from (select * from participates where movie_id in "
        "(select movie_id from participates group by 1 having count(distinct role) = 2)) a "
        "join participates b on a.movie_id = b.movie_id and a.role = 'director' and b.role = 'writer' and a.person_id <> b.person_id "
        "join named dn on dn.person_id = a.person_id join named wn on wn.person_id = b.person_id group by 1, 2 order by n desc, 1, 2 limit 20"
    ),
    "pipeline_q4": _over(
        "select person_id, popularity, round(sum(score)::double / count(*), 6) as avg_rating from pop join known using (person_id) "
        "join rating using (movie_id) group by 1, 2"
    ),
    "pipeline_q5": _over(
        "select person_id, name, min(start_year) as debut, max(start_year) as last_active, max(start_year) - min(start_year) as career_span "
        "from named join known using (person_id) join title_ok using (movie_id) group by 1, 2 having count(start_year) > 5 "
        "order by career_span desc, name, person_id limit 20"
    ),
    "pipeline_q6": _over("select genre, round(sum(score)::double / count(*), 6) as avg_rating from movie_genre join rating using (movie_id) group by 1"),
    "pipeline_q7": _over(
        "select title, genre, round(a, 6) as avg_rating, rating_count from (select title, genre, sum(score)::double / count(*) as a, "
        "count(*) as rating_count from movie_title join movie_genre using (movie_id) join rating using (movie_id) group by 1, 2 "
        "having count(*) >= 10 order by a desc, title, genre limit 20) x"
    ),
    "pipeline_q8": _over("select profession, popularity from pop join job using (person_id) where popularity > 0"),
}
