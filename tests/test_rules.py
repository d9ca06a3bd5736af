"""Constraints keep, explain and count."""

from datetime import datetime

from kinomill.operators import constraints as C
from kinomill.plans import trusted

AS_OF = "2024-06-30"
CREW = "tconst string, directors array<string>, writers array<string>"


def test_null_arrays_drop_or_count_as_empty(spark):
    df = spark.createDataFrame(
        [
            ("tt1", ["nm1"], None),
            ("tt2", ["nm1", "", None], []),
            ("tt3", [], []),
            ("tt4", ["x1"], ["nm2"]),
            (None, ["nm1"], ["nm1"]),
            ("xx5", ["nm1"], ["nm1"]),
            ("tt6", None, None),
        ],
        CREW,
    )
    kept = trusted.trust(df, "title_crew").clean.collect()
    assert [(r.tconst, r.directors) for r in kept] == [("tt2", ["nm1"])]
    filled = trusted.trust(df, "title_crew", null_arrays="empty").clean.collect()
    assert sorted(r.tconst for r in filled) == ["tt1", "tt2"]


def test_titles(spark):
    schema = "tconst string, originalTitle string, isAdult boolean, startYear int, endYear string, runtimeMinutes int"
    df = spark.createDataFrame(
        [
            ("ok", "o", False, 1999, None, 90),
            ("end", "o", True, 1999, "2001", 0),
            ("old", "o", False, 1700, None, 90),
            ("late", "o", False, 2030, None, 90),
            ("noyear", "o", False, None, None, 90),
            ("badend", "o", False, 1999, "soon", 90),
            ("norun", "o", False, 1999, None, None),
            ("noadult", "o", None, 1999, None, 1),
        ],
        schema,
    )
    found = trusted.trust(df, "title_basics", as_of=AS_OF)
    assert sorted(r.tconst for r in found.clean.collect()) == ["end", "ok"]
    assert "originalTitle" not in found.clean.columns
    names = {r.tconst: r.violated for r in found.violations.collect()}
    assert names["late"] == ["in_range(startYear)"] and len(names) == 6
    assert found.clean.count() + found.violations.count() == df.count()


def test_names(spark):
    schema = "nconst string, birthYear int, deathYear int, knownForTitles array<string>"
    df = spark.createDataFrame(
        [
            ("nm1", None, None, ["tt1", ""]),
            ("nm2", 1900, 1899, ["tt1"]),
            ("nm3", 1900, None, ["x"]),
            ("nm4", 1900, 1950, None),
            ("nm5", 1900, 1950, []),
        ],
        schema,
    )
    assert sorted(r.nconst for r in trusted.trust(df, "name_basics", as_of=AS_OF).clean.collect()) == ["nm1", "nm5"]


def test_ratings_dedupe_and_text_time(spark):
    t = datetime(2020, 1, 2, 3, 4, 5)
    df = spark.createDataFrame(
        [("u", "tt1", 10, t), ("u", "tt1", 10, t), ("u", "tt1", 9, t), ("u", "tt1", 11, t), (None, "tt1", 5, t)],
        "user_id string, movie_id string, rating int, rating_timestamp timestamp",
    )
    got = sorted((r.rating, r.rating_timestamp) for r in trusted.trust(df, "ratings").clean.collect())
    assert got == [(9, "2020-01-02 03:04:05"), (10, "2020-01-02 03:04:05")]


def test_band_depends_on_missing_share_before_the_rules(spark):
    schema = (
        "imdb_id string, tmdb_id int, original_name string, adult boolean, popularity double, gender string, "
        "known_for string, known_for_popularity double"
    )

    def people(missing):
        good = [(f"nm{i}", i, "o", False, float(i), "Male", "tt1", 1.0) for i in range(100)]
        return spark.createDataFrame(good + [("nm", 1, "o", False, None, "Male", "tt1", 1.0)] * missing, schema)

    assert trusted.trust(people(0), "crew_data").clean.count() == 91
    assert trusted.trust(people(30), "crew_data").clean.count() == 100
    assert trusted.trust(people(0).where("false"), "crew_data").clean.count() == 0


def test_counts_per_rule(spark):
    df = spark.createDataFrame([(1,), (None,), (20,)], "rating int")
    got = {r["rule"]: r["violations"] for r in C.violation_counts(df, [C.in_range("rating", 0, 10), C.not_null("rating")]).collect()}
    assert got == {"in_range(rating)": 2, "not_null(rating)": 1}
