"""Registered queries: constraints, the outlier band and the trusted zone."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import constraints as C
from ..operators.outliers import trim_outliers as keep_band
from ..plans import domain as D
from ..plans import trusted
from ..sources.readers import entities_of_kind, numeric_ids
from .views import movie, person, with_views

AS_OF = "2024-06-30"


def constraint_range(spark, d):
    rules = trusted.title_rules(as_of=AS_OF)
    kept = C.apply_constraints(D.title_basics(spark, d), rules)
    return kept.select("tconst", "startYear", "endYear", "runtimeMinutes", "isAdult")


def _holed_crew(spark, d):
    """Credits with a NULL list, a foreign id or an empty element here and there."""
    line = F.col("l_orderkey") % 10
    who = F.when(line == 0, F.concat(F.lit("xx"), F.col("l_suppkey").cast("string"))).otherwise(D.person_id("l_suppkey"))
    directors = (
        F.when(line == 1, F.lit(None))
        .when(line == 2, F.array().cast("array<string>"))
        .when(line == 3, F.array(F.lit(""), who))
        .otherwise(F.array(who))
    )
    writers = F.when(F.col("l_linenumber") == 2, F.array(who)).otherwise(F.array().cast("array<string>"))
    return D.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", D.movie_id("l_partkey").alias("tconst"), directors.alias("directors"), writers.alias("writers")
    )


def _crew_result(spark, d, null_arrays):
    treatment = trusted.TREATMENTS["title_crew"]
    ready = trusted.prepare(_holed_crew(spark, d), treatment)
    kept = C.apply_constraints(ready, trusted.crew_rules(null_arrays=null_arrays))
    return kept.select(
        "l_orderkey",
        "l_linenumber",
        "tconst",
        F.coalesce(F.array_join("directors", ","), F.lit("-")).alias("directors"),
        F.array_join("writers", ",").alias("writers"),
    )


def constraint_arrays(spark, d):
    return _crew_result(spark, d, "drop")


def constraint_arrays_null_as_empty(spark, d):
    return _crew_result(spark, d, "empty")


def constraint_cross_column(spark, d):
    kept = C.apply_constraints(D.name_basics(spark, d), trusted.name_rules(as_of=AS_OF))
    return kept.select("nconst", "birthYear", "deathYear", F.col("knownForTitles")[0].alias("title"))


def constraint_prefix(spark, d):
    ids = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("xx"), F.col("p_name"))).when(
        F.col("p_partkey") % 4 != 1, D.movie_id("p_partkey")
    )
    movies = D.table(spark, d, "part").select("p_partkey", ids.alias("movie_id"))
    return C.apply_constraints(movies, trusted.movie_rules())


def constraint_not_null(spark, d):
    users = D.table(spark, d, "customer").select(
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("user_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("twitter_id"),
    )
    return C.apply_constraints(users, trusted.user_rules())


def constraint_between(spark, d):
    scores = D.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_quantity") / 4 - 1).cast("int").alias("rating"),
    )
    return C.apply_constraints(scores, trusted.rating_rules())


def constraint_domain(spark, d):
    kept = C.apply_constraints(D.crew_data(spark, d), trusted.person_rules())
    return kept.select("imdb_id", "gender", "popularity", "known_for", "known_for_popularity")


def constraint_violations(spark, d):
    found = C.violations(D.title_basics(spark, d), trusted.title_rules(as_of=AS_OF))
    return found.select("tconst", F.array_join(F.array_sort("violated"), ";").alias("violated"))


def violation_counts(spark, d):
    return C.violation_counts(D.title_basics(spark, d), trusted.title_rules(as_of=AS_OF))


def trim_outliers(spark, d):
    return keep_band(D.table(spark, d, "events").select("event_id", "value"), "value")


def trim_outliers_skipped(spark, d):
    """Too many values are missing, so nothing is cut off."""
    gappy = D.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")
    )
    return keep_band(gappy, "value")


def _entities(spark, d):
    people = D.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("http://example.org/kg/Person/"), D.person_id("s_suppkey")).alias("entity")
    )
    movies = D.table(spark, d, "part").select(
        F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("x"), F.col("p_partkey").cast("string")))
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("id"),
        F.concat(F.lit("http://example.org/kg/Movie/"), D.movie_id("p_partkey")).alias("entity"),
    )
    return people.unionByName(movies)


def entity_kind(spark, d):
    return entities_of_kind(numeric_ids(_entities(spark, d)), "Movie")


def trust_zone(spark, d):
    """Clean person table: rules, popularity band, duplicates."""
    clean = trusted.trust(D.crew_data(spark, d), "crew_data").clean
    return clean.select("imdb_id", "tmdb_id", "name", "adult", "popularity", "gender", "known_for", "known_for_popularity")


def trust_metrics(spark, d):
    found = trusted.trust(D.crew_data(spark, d), "crew_data").metrics
    return found.where("metric in ('missing_ratio', 'complete_ratio', 'redundancy_factor', 'distinct_count')").select(
        F.coalesce("column", F.lit("*")).alias("column"), "metric", F.round("value", 6).alias("value")
    )


def trust_violations(spark, d):
    found = trusted.trust(D.crew_data(spark, d), "crew_data").violations
    return found.select("imdb_id", "known_for", F.array_join("violated", ";").alias("violated"))


def trust_ratings(spark, d):
    return trusted.trust(D.ratings(spark, d), "ratings").clean


QUERIES = {
    f.__name__: f
    for f in (
        constraint_range, constraint_arrays, constraint_arrays_null_as_empty, constraint_cross_column,
        constraint_prefix, constraint_not_null, constraint_between, constraint_domain, constraint_violations,
        violation_counts, trim_outliers, trim_outliers_skipped, entity_kind, trust_zone, trust_metrics,
        trust_violations, trust_ratings,
    )
}

_TITLE_TESTS = {
    "in_domain(isAdult)": "is_adult in (false, true)",
    "in_range(endYear)": "(end_year is null or (try_cast(end_year as int) >= 1800 and try_cast(end_year as int) <= 2024))",
    "in_range(runtimeMinutes)": "runtime >= 0",
    "in_range(startYear)": "(start_year >= 1800 and start_year <= 2024)",
}
_FAILED_NAMES = " || ".join(f"(case when ({t}) is not true then '{n};' else '' end)" for n, t in _TITLE_TESTS.items())
_TITLE_OK = " and ".join(_TITLE_TESTS.values())

_WHO = f"case when l_orderkey % 10 = 0 then 'xx' || cast(l_suppkey as varchar) else {person('l_suppkey')} end"


def _crew_sql(null_arrays):
    directors = (
        f"case l_orderkey % 10 when 1 then null when 2 then [] else [{_WHO}] end"
        if null_arrays == "drop"
        else f"case when l_orderkey % 10 in (1, 2) then [] else [{_WHO}] end"
    )
    shown = "case when l_orderkey % 10 = 1 then '-' else array_to_string(dirs, ',') end"
    return (
        f"select l_orderkey, l_linenumber, tconst, coalesce({shown}, '') as directors, coalesce(array_to_string(wris, ','), '') as writers "
        f"from (select l_orderkey, l_linenumber, {movie('l_partkey')} as tconst, {directors} as dirs, "
        f"case when l_linenumber = 2 then [{_WHO}] else [] end as wris from lineitem) x "
        "where dirs is not null and len(list_filter(dirs, lambda x: not starts_with(x, 'nm'))) = 0 "
        "and len(list_filter(wris, lambda x: not starts_with(x, 'nm'))) = 0 and len(dirs) + len(wris) > 0"
    )


_PERSON_OK = (
    "starts_with(imdb_id, 'nm') and popularity >= 0 and known_for_popularity >= 0 "
    "and gender in ('Female', 'Male', 'Non-binary') and starts_with(known_for, 'tt')"
)

ORACLE = {
    "constraint_range": with_views(
        'select tconst, start_year as "startYear", end_year as "endYear", runtime as "runtimeMinutes", is_adult as "isAdult" '
        f"from title_basics where {_TITLE_OK}",
        "title_basics",
    ),
    "constraint_arrays": _crew_sql("drop"),
    "constraint_arrays_null_as_empty": _crew_sql("empty"),
    "constraint_cross_column": with_views(
        'select nconst, birth_year as "birthYear", death_year as "deathYear", title from name_basics '
        "where birth_year between 1800 and 2024 and (death_year is null or (death_year between 1800 and 2024 and birth_year <= death_year))",
        "name_basics",
    ),
    "constraint_prefix": f"select p_partkey, {movie('p_partkey')} as movie_id from part where p_partkey % 4 in (2, 3)",
    "constraint_not_null": "select c_custkey as user_id, c_name as twitter_id from customer where c_custkey % 3 <> 0 and c_custkey % 5 <> 0",
    "constraint_between": "select l_orderkey as user_id, l_partkey as movie_id, r as rating from "
    "(select l_orderkey, l_partkey, cast(trunc(l_quantity / 4 - 1) as int) as r from lineitem) x where r between 0 and 10",
    "constraint_domain": with_views(
        f"select imdb_id, gender, popularity, known_for, known_for_popularity from crew_data where {_PERSON_OK}", "crew_data"
    ),
    "constraint_violations": with_views(
        f"select tconst, rtrim({_FAILED_NAMES}, ';') as violated from title_basics where ({_TITLE_OK}) is not true", "title_basics"
    ),
    "violation_counts": with_views(
        " union all ".join(
            f"select '{n}' as rule, count(*) filter (where ({t}) is not true) as violations from title_basics"
            for n, t in _TITLE_TESTS.items()
        ),
        "title_basics",
    ),
    "trim_outliers": "select event_id, value from events where value between "
    "(select quantile_disc(value, 0.05) from events) and (select quantile_disc(value, 0.95) from events)",
    "trim_outliers_skipped": "select event_id, case when event_id % 7 <> 0 then value end as value from events",
    "entity_kind": "select p_partkey as id, 'http://example.org/kg/Movie/' || " + movie("p_partkey") + " as entity from part where p_partkey % 10 <> 0",
    "trust_zone": with_views(
        f"select distinct imdb_id, tmdb_id, name, adult, popularity, gender, known_for, known_for_popularity from crew_data where {_PERSON_OK} "
        f"and popularity between (select quantile_disc(popularity, 0.05) from crew_data where {_PERSON_OK}) "
        f"and (select quantile_disc(popularity, 0.95) from crew_data where {_PERSON_OK})",
        "crew_data",
    ),
    "trust_metrics": with_views(
        " union all ".join(
            f"select '{c}' as \"column\", 'missing_ratio' as metric, 0.0::double as value "
            f"union all select '{c}', 'distinct_count', count(distinct {c})::double from crew_data"
            for c in ("imdb_id", "tmdb_id", "name", "original_name", "adult", "popularity", "gender", "known_for", "known_for_popularity")
        )
        + " union all select '*', 'complete_ratio', 1.0::double union all select '*', 'redundancy_factor', "
        "round((select count(*) from crew_data)::double / (select count(*) from (select distinct * from crew_data) y), 6)",
        "crew_data",
    ),
    "trust_violations": with_views(
        "select imdb_id, known_for, rtrim((case when popularity >= 0 then '' else 'in_range(popularity);' end) || "
        "(case when gender = 'NotSet' then 'in_domain(gender);' else '' end), ';') as violated from crew_data "
        "where popularity < 0 or gender = 'NotSet' "
        f"union all select imdb_id, known_for, 'in_band(popularity)' from crew_data where {_PERSON_OK} "
        f"and not popularity between (select quantile_disc(popularity, 0.05) from crew_data where {_PERSON_OK}) "
        f"and (select quantile_disc(popularity, 0.95) from crew_data where {_PERSON_OK})",
        "crew_data",
    ),
    "trust_ratings": with_views(
        "select distinct user_id, movie_id, rating, strftime(rating_timestamp, '%Y-%m-%d %H:%M:%S') as rating_timestamp "
        "from ratings where rating between 0 and 10",
        "ratings",
    ),
}
