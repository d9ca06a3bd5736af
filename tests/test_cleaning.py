"""Golden rows for formatting, imputation and metrics."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kinomill.functions import scalars as S
from kinomill.functions import text as T
from kinomill.operators import dedupe, impute, quality, summaries
from kinomill.plans import formatted
from kinomill.sources import readers, schemas


def test_markers_and_white_space(spark):
    df = spark.createDataFrame([(" a\t b\n",), ("N/A",), (" NaN ",), ("",), ("NULL",), ("NA",), ("\\N",), (None,)], "s string")
    assert [r.s for r in T.format_values(df).collect()] == ["a b", None, None, None, None, None, "\\N", None]
    assert [r.s for r in T.format_values(df, T.NA_MARKERS_BACKSLASH).collect()][6] is None
    once = T.format_values(df)
    assert once.collect() == T.format_values(once).collect()


def test_accents(spark):
    df = spark.createDataFrame([("Àéîõü ñ ç Š ž",), ("Straße Æther Œuvre Øre Łódź",), ("é",), ("日本",), (None,)], "s string")
    out = [r[0] for r in df.select(T.fold_accents(F.col("s"))).collect()]
    assert out == ["Aeiou n c S z", "Strasse AEther OEuvre Ore Lodz", "e", "日本", None]
    plain = [r[0] for r in df.select(T.fold_accents(F.col("s"), expand_letters=False)).collect()]
    assert plain[1] == "Straße Æther Œuvre Øre Łodz"


def test_titles_with_and_without_year(spark):
    df = spark.createDataFrame([("Up (2009)",), ("Up (2009) ",), ("Up",), ("(2009) Up",), ("1984 (1956)",), (None,)], "t string")
    got = df.select(S.strip_year(F.col("t")), S.extract_year(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("Up", 2009), ("Up", 2009), ("Up", None), ("(2009) Up", None), ("1984", 1956), (None, None)]


def test_ids_keep_zeros_and_nulls(spark):
    df = spark.createDataFrame([("0114709",), (None,)], "i string")
    assert [r[0] for r in df.select(S.prefix_id(F.col("i"), "tt")).collect()] == ["tt0114709", None]


def test_iri_encoding(spark):
    df = spark.createDataFrame([("Sci-Fi",), ("a b",), ("Brand#1",), ("é*~",), ("\\N",)], "g string")
    assert [r[0] for r in df.select(S.iri_part(F.col("g"))).collect()] == ["Sci-Fi", "a%20b", "Brand%231", "%C3%A9%2A~", "%5CN"]


def test_delimited_with_quotes(spark, tmp_path):
    (tmp_path / "movies.dat").write_text('0000003::"Quoted" one (2001)::Drama|Comedy\n0000004::Café  noir::\n', encoding="utf-8")
    raw = readers.read_delimited(spark, str(tmp_path / "movies.dat"), schemas.MOVIES)
    got = sorted(tuple(r) for r in formatted.format_movies(raw).collect())
    assert got == [("tt0000003", '"Quoted" one', 2001, ["Drama", "Comedy"]), ("tt0000004", "Cafe noir", None, None)]


def test_tsv_with_open_quote_and_bad_numbers(spark, tmp_path):
    import gzip

    lines = [
        "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres",
        'tt1\tmovie\t"Open\tÉ\t0\t1999\t\\N\t\\N\tDrama,War',
        "tt2\tmovie\tx\ty\t1\t\\N\t2001\t90\t\\N",
    ]
    with gzip.open(tmp_path / "t.tsv.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    df = formatted.format_title_basics(readers.read_tsv_gz(spark, str(tmp_path / "t.tsv.gz"), schemas.TITLE_BASICS, 2))
    got = sorted(tuple(r) for r in df.collect())
    assert got[0] == ("tt1", "movie", '"Open', "E", False, 1999, None, None, ["Drama", "War"])
    assert got[1] == ("tt2", "movie", "x", "y", True, None, "2001", 90, None)


def test_json_object_per_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{\n "nm1": {"imdb_id": "nm1", "tmdb_data": {"id": 5, "name": "Zoë", "gender": 1, "popularity": 2.5,'
        ' "known_for": [{"id": 10, "popularity": 1.0}, {"id": 11, "popularity": 2.0}]}},\n "nm2": null,\n'
        ' "nm3": {"imdb_id": "nm3", "tmdb_data": {"id": 6, "name": "N/A", "gender": 9, "known_for": []}}\n}'
    )
    people = readers.read_json_map(spark, str(tmp_path / "p.json"), schemas.PERSON_PAYLOAD, layout="file")
    assert sorted((r["key"], r["value"] is None) for r in people.collect()) == [("nm1", False), ("nm2", True), ("nm3", False)]
    links = spark.createDataFrame([(1, "0000010", "10")], schemas.LINKS)
    got = formatted.format_crew_data(people, links)
    assert sorted(tuple(r) for r in got.select("imdb_id", "name", "gender", "known_for").collect()) == [
        ("nm1", "Zoe", "Female", "11"),
        ("nm1", "Zoe", "Female", "tt0000010"),
    ]
    kept = formatted.format_crew_data(people, links, keep_without_titles=True)
    assert kept.where("imdb_id = 'nm3' and known_for is null and name is null and gender is null").count() == 1


def test_ratings_and_names(spark):
    raw = spark.createDataFrame([("1", "0000007", "8", "1370000000"), ("2", "0000007", "x", "soon")], schemas.RATINGS)
    got = [tuple(r) for r in formatted.format_ratings(raw).withColumn("rating_timestamp", F.col("rating_timestamp").cast("string")).collect()]
    assert got == [("1", "tt0000007", 8, "2013-05-31 11:33:20"), ("2", "tt0000007", None, None)]
    people = spark.createDataFrame([("nm1", "A  B", "1950", "\\N", "actor,writer", "\\N")], schemas.NAME_BASICS)
    assert [tuple(r) for r in formatted.format_name_basics(people).collect()] == [("nm1", "A B", 1950, None, ["actor", "writer"], None)]


def test_midpoint_uses_nearest_neighbours(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 100.0), (5, None)], "t int, v double")
    assert [r.v for r in impute.impute_midpoint(df, ["t"], columns=["v"]).orderBy("t").collect()] == [10, 20, 30, 100, 100]
    lin = spark.createDataFrame([(0, 0.0), (1, None), (4, 40.0)], "t int, v double")
    assert [r.v for r in impute.impute_midpoint(lin, ["t"], mode="linear").orderBy("t").collect()] == [0, 10, 40]
    empty = spark.createDataFrame([(1, None), (2, None)], "t int, v int")
    assert [r.v for r in impute.impute_temporal(empty, ["v"], ["t"]).collect()] == [0, 0]
    with pytest.raises(ValueError):
        impute.impute_midpoint(df, ["t"], mode="cubic")


def test_mode_counts_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", "x"), ("b", None), (None, None)], "p string, q string")
    got = [tuple(r) for r in impute.impute_mode(df).collect()]
    assert got == [("b", "unknown"), ("a", "unknown"), ("a", "x"), ("b", "unknown"), ("a", "unknown")]


def test_numeric_fill(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (None, 4.0, None)], "a int, b double, c double")
    assert [tuple(r) for r in impute.impute_numeric(df).collect()] == [(1, 1, 0), (2, 1, 0), (1, 4, 0)]
    assert [tuple(r) for r in impute.impute_numeric(df, strategy="mean", default=-1.0).collect()] == [(1, 1, -1), (2, 2.5, -1), (1.5, 4, -1)]
    assert impute.impute_numeric(df, approximate=True).count() == 3
    with pytest.raises(ValueError):
        impute.impute_numeric(df, strategy="max")


def test_metrics_on_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "`odd name` int, s string")
    prof = {r["column"]: r for r in quality.profile(df).collect()}
    assert (prof["s"]["distinct_count"], prof["s"]["value_count"], prof["odd name"]["mean"]) == (2, 2, pytest.approx(4 / 3))
    assert {r["column"]: round(r["missing_ratio"], 3) for r in quality.column_completeness(df).collect()} == {"odd name": 0, "s": 0.333}
    assert quality.relation_completeness(df).first()[0] == pytest.approx(2 / 3)
    assert tuple(quality.redundancy(df).first()) == (3, 2, 1.5)
    none = df.where("false")
    assert quality.column_completeness(none).count() == 0
    assert quality.relation_completeness(none).first()[0] == 0.0
    assert tuple(quality.redundancy(none).first()) == (0, 0, None)
    assert "rows: 3" in quality.report(quality.profile(df, approximate=True))


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 4),), (None,)], "d date")
    assert sorted(r.day.day for r in quality.missing_dates(df, "d").collect()) == [2, 3]
    assert [r.present for r in quality.date_coverage(df, "d").orderBy("day").collect()] == [True, False, False, True]
    assert quality.is_complete_calendar(df, "d").first()["is_complete"] is False
    assert quality.missing_dates(df.where("false"), "d").count() == 0


def test_timeliness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 1, 3),)], "t timestamp")
    got = quality.timeliness(df, "t", "t", as_of="2024-01-03").first()["timeliness_score"]
    assert got == pytest.approx((1 / 25 + 1) / 2, rel=1e-6)


def test_histogram_edges(spark):
    one = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    bins = summaries.histogram(one, "v").orderBy("bin").collect()
    assert len(bins) == 30 and [b.n for b in bins if b.n] == [2] and bins[0].bin_low == 4.5 and bins[29].bin_high == 5.5
    ends = spark.createDataFrame([(0.0,), (30.0,)], "v double")
    assert [b.bin for b in summaries.histogram(ends, "v").collect() if b.n] == [0, 29]


def test_trend_needs_two_rows(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert tuple(summaries.linear_trend(one, "x", "y").first()) == (1, None, None, None)


def test_dedupe_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (None, 1, "n"), (None, 0, "m")], "k int, o int, v string")
    assert sorted((r.k or 0, r.v) for r in dedupe.dedupe_key(df, ["k"], ["o"]).collect()) == [(0, "m"), (1, "b")]
    assert sorted((r.k or 0, r.v) for r in dedupe.dedupe_key(df, ["k"], ["o"], keep="last").collect()) == [(0, "n"), (1, "c")]
