"""DuckDB text of the domain views, for the oracle side only."""

_MOVIE = "concat('tt', lpad(cast({} as varchar), 7, '0'))"
_PERSON = "concat('nm', lpad(cast({} as varchar), 7, '0'))"
_GENDER = "case s_nationkey % 4 when 1 then 'Female' when 2 then 'Male' when 3 then 'Non-binary' else 'NotSet' end"
_PROFESSION = "case s_suppkey % 3 when 0 then 'actor' when 1 then 'director' else 'writer' end"


def movie(key: str) -> str:
    return _MOVIE.format(key)


def person(key: str) -> str:
    return _PERSON.format(key)


VIEWS = {
    "movie_title": ((), f"select {movie('p_partkey')} as movie_id, p_name as title from part"),
    "movie_attr": ((), f"select {movie('p_partkey')} as movie_id, 1950 + p_size as start_year from part"),
    "movie_genre": (
        (),
        f"select distinct {movie('p_partkey')} as movie_id, g as genre from "
        "(select p_partkey, p_type as g from part union all select p_partkey, p_brand as g from part) x",
    ),
    "person": (
        (),
        f"select {person('s_suppkey')} as person_id, s_name as name, s_acctbal as popularity, "
        f"{_GENDER} as gender, {_PROFESSION} as profession from supplier",
    ),
    "participates": (
        (),
        f"select distinct {person('l_suppkey')} as person_id, {movie('l_partkey')} as movie_id, "
        "case l_linenumber when 1 then 'director' else 'writer' end as role from lineitem where l_linenumber in (1, 2)",
    ),
    "known_for": (("participates",), "select distinct person_id, movie_id from participates"),
    "rating": (
        (),
        f"select distinct o_custkey as user_id, {movie('l_partkey')} as movie_id, "
        "cast(ceil(l_quantity / 5) as int) as score from lineitem join orders on l_orderkey = o_orderkey",
    ),
    "crew_data": (
        (),
        f"select {person('s_suppkey')} as imdb_id, cast(s_suppkey as int) as tmdb_id, s_name as name, "
        f"s_name as original_name, s_suppkey % 17 = 0 as adult, s_acctbal as popularity, {_GENDER} as gender, "
        f"{movie('l_partkey')} as known_for, l_quantity as known_for_popularity "
        "from lineitem join supplier on l_suppkey = s_suppkey where l_linenumber in (1, 2)",
    ),
    "ratings": (
        (),
        f"select cast(o_custkey as varchar) as user_id, {movie('l_partkey')} as movie_id, "
        "cast(ceil(l_quantity / 5) as int) as rating, o_orderdate as rating_timestamp "
        "from lineitem join orders on l_orderkey = o_orderkey",
    ),
    "title_basics": (
        (),
        f"select {movie('p_partkey')} as tconst, 'movie' as title_type, p_name as primary_title, "
        "p_partkey % 17 = 0 as is_adult, "
        "case when p_partkey % 13 = 0 then 1700 else 1950 + p_size end as start_year, "
        "case when p_partkey % 5 = 0 then '1999' when p_partkey % 11 = 0 then 'soon' end as end_year, "
        "case when p_partkey % 19 <> 0 then 60 + p_size end as runtime, p_type, p_brand from part",
    ),
    "name_basics": (
        (),
        f"select {person('s_suppkey')} as nconst, s_name as primary_name, 1900 + s_nationkey as birth_year, "
        "case when s_suppkey % 2 = 0 then 1890 + s_nationkey * 2 end as death_year, "
        f"{_PROFESSION} as job0, case when s_nationkey % 2 = 0 then 'producer' else 'editor' end as job1, "
        f"{movie('l_partkey')} as title from (select distinct l_suppkey, l_partkey from lineitem "
        "where l_linenumber in (1, 2)) w join supplier on l_suppkey = s_suppkey",
    ),
    "crew_credit": (
        (),
        f"select {movie('l_partkey')} as tconst, {person('l_suppkey')} as nconst, "
        "case l_linenumber when 1 then 'director' else 'writer' end as role from lineitem where l_linenumber in (1, 2)",
    ),
    # events with every seventh value missing
    "gappy": ((), "select event_id, ts, user_id, event_type, case when event_id % 7 = 0 then null else value end as value from events"),
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the views it needs, dependencies first."""
    ordered: list[str] = []

    def add(name):
        for dependency in VIEWS[name][0]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "with " + ", ".join(f"{n} as ({VIEWS[n][1]})" for n in ordered) + " " + body
