"""Registered queries: the analytical queries and the numbers behind their charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import pair_label, shorten
from ..operators import summaries
from ..plans import analytics as A
from ..plans import domain as D
from .views import with_views


def _r(column, digits=6):
    return F.round(column, digits).alias(column)


def profession_gender(spark, d):
    p = D.person(spark, d)
    return A.profession_gender(p.select("person_id", "profession"), p.select("person_id", "gender"))


def genre_by_decade(spark, d):
    return A.genre_by_decade(D.movie_attr(spark, d), D.movie_genre(spark, d))


def collaborations(spark, d):
    return A.collaborations(D.participates(spark, d), D.person(spark, d).select("person_id", "name"))


def popularity_vs_rating(spark, d):
    found = A.popularity_vs_rating(
        D.person(spark, d).select("person_id", "popularity"), D.known_for(spark, d), D.rating(spark, d)
    )
    return found.select("person_id", "popularity", _r("avg_rating"))


def career_longevity(spark, d):
    return A.career_longevity(
        D.person(spark, d).select("person_id", "name"), D.known_for(spark, d), D.movie_attr(spark, d)
    )


def genre_rating(spark, d):
    return A.genre_rating(D.movie_genre(spark, d), D.rating(spark, d)).select("genre", _r("avg_rating"))


def top_rated(spark, d):
    best = A.top_rated(D.movie_title(spark, d), D.movie_genre(spark, d), D.rating(spark, d))
    return best.select("title", "genre", _r("avg_rating"), "rating_count")


def popularity_distribution(spark, d):
    p = D.person(spark, d)
    return A.popularity_distribution(p.select("person_id", "popularity"), p.select("person_id", "profession"))


def top_groups(spark, d):
    return summaries.top_groups(genre_by_decade(spark, d), "genre", "n", 5)


def pivot_counts(spark, d):
    genders = ["Female", "Male", "Non-binary", "NotSet"]
    wide = summaries.pivot_filled(profession_gender(spark, d), "profession", "gender", "n", genders)
    return wide.select(
        "profession",
        *[F.col(f"`{g}`").alias(g.lower().replace("-", "_")) for g in genders],
    )


def group_share(spark, d):
    return summaries.group_share(genre_by_decade(spark, d), ["decade"], "n").select("decade", "genre", _r("share"))


def linear_trend(spark, d):
    trend = summaries.linear_trend(D.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return trend.select("n", _r("slope", 3), _r("intercept", 2), _r("r2"))


def popularity_trend(spark, d):
    points = A.popularity_vs_rating(
        D.person(spark, d).select("person_id", "popularity"), D.known_for(spark, d), D.rating(spark, d)
    )
    trend = summaries.linear_trend(points, "popularity", "avg_rating")
    return trend.select("n", _r("slope", 9), _r("intercept"), _r("r2"))


def box_stats(spark, d):
    stats = summaries.box_stats(D.table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    figures = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return stats.select("l_returnflag", *[_r(c, 4) for c in figures], "outliers", "n")


def histogram(spark, d):
    bins = summaries.histogram(D.table(spark, d, "lineitem"), "l_extendedprice")
    return bins.select("bin", _r("bin_low", 3), _r("bin_high", 3), "n")


def histogram_nan(spark, d):
    """Every seventh price is not a number, every eleventh infinite: neither moves the edges or is counted."""
    key = F.col("l_orderkey")
    price = F.when(key % 7 == 0, float("nan")).when(key % 11 == 0, float("inf")).otherwise(F.col("l_extendedprice"))
    bins = summaries.histogram(D.table(spark, d, "lineitem").select(price.alias("price")), "price")
    return bins.select("bin", _r("bin_low", 3), _r("bin_high", 3), "n")


def truncate_label(spark, d):
    docs = D.table(spark, d, "documents")
    return docs.select(
        "doc_id", shorten(F.col("text")).alias("label"), pair_label(F.col("lang"), F.col("source")).alias("pair")
    )


QUERIES = {
    "genre_by_decade": genre_by_decade,
    "profession_gender": profession_gender,
    "collaborations": collaborations,
    "popularity_vs_rating": popularity_vs_rating,
    "career_longevity": career_longevity,
    "genre_rating": genre_rating,
    "top_rated": top_rated,
    "popularity_distribution": popularity_distribution,
    "top_groups": top_groups,
    "pivot_counts": pivot_counts,
    "group_share": group_share,
    "linear_trend": linear_trend,
    "popularity_trend": popularity_trend,
    "box_stats": box_stats,
    "histogram": histogram,
    "histogram_nan": histogram_nan,
    "truncate_label": truncate_label,
}

_GENRE_BY_DECADE = (
    "select cast(floor(start_year / 10) * 10 as bigint) as decade, genre, count(*) as n "
    "from movie_attr join movie_genre using (movie_id) where start_year > 1900 group by 1, 2"
)
_POPULARITY_RATING = (
    "select person_id, popularity, sum(score)::double / count(*) as avg_rating from person join known_for using (person_id) "
    "join rating using (movie_id) group by 1, 2"
)

ORACLE = {
    "genre_by_decade": with_views(_GENRE_BY_DECADE, "movie_attr", "movie_genre"),
    "profession_gender": with_views(
        "select profession, gender, count(*) as n from person group by 1, 2", "person"
    ),
    "collaborations": with_views(
        "select dn.name as director_name, wn.name as writer_name, count(*) as n from participates a "
        "join participates b on a.movie_id = b.movie_id and a.role = 'director' and b.role = 'writer' "
        "and a.person_id <> b.person_id join person dn on dn.person_id = a.person_id "
        "join person wn on wn.person_id = b.person_id group by 1, 2 order by n desc, 1, 2 limit 20",
        "participates",
        "person",
    ),
    "popularity_vs_rating": with_views(
        f"select person_id, popularity, round(avg_rating, 6) as avg_rating from ({_POPULARITY_RATING}) x",
        "person",
        "known_for",
        "rating",
    ),
    "career_longevity": with_views(
        "select person_id, name, min(start_year) as debut, max(start_year) as last_active, "
        "max(start_year) - min(start_year) as career_span from person join known_for using (person_id) "
        "join movie_attr using (movie_id) group by 1, 2 having count(start_year) > 5 "
        "order by career_span desc, name, person_id limit 20",
        "person",
        "known_for",
        "movie_attr",
    ),
    "genre_rating": with_views(
        "select genre, round(sum(score)::double / count(*), 6) as avg_rating from movie_genre join rating using (movie_id) group by 1",
        "movie_genre",
        "rating",
    ),
    "top_rated": with_views(
        "select title, genre, round(a, 6) as avg_rating, rating_count from (select title, genre, "
        "sum(score)::double / count(*) as a, count(*) as rating_count from movie_title join movie_genre using (movie_id) "
        "join rating using (movie_id) group by 1, 2 having count(*) >= 10 order by a desc, title, genre limit 20) x",
        "movie_title",
        "movie_genre",
        "rating",
    ),
    "popularity_distribution": with_views(
        "select profession, popularity from person where popularity > 0", "person"
    ),
    "top_groups": with_views(
        f"select * from ({_GENRE_BY_DECADE}) x where genre in "
        f"(select genre from ({_GENRE_BY_DECADE}) y group by genre order by sum(n) desc, genre limit 5)",
        "movie_attr",
        "movie_genre",
    ),
    "pivot_counts": with_views(
        "select profession, count(*) filter (where gender = 'Female') as female, "
        "count(*) filter (where gender = 'Male') as male, count(*) filter (where gender = 'Non-binary') as non_binary, "
        "count(*) filter (where gender = 'NotSet') as notset from person group by 1",
        "person",
    ),
    "group_share": with_views(
        f"select decade, genre, round(100.0 * n / sum(n) over (partition by decade), 6) as share from ({_GENRE_BY_DECADE}) x",
        "movie_attr",
        "movie_genre",
    ),
    "linear_trend": (
        "select count(*) as n, round(regr_slope(l_extendedprice, l_quantity), 3) as slope, "
        "round(regr_intercept(l_extendedprice, l_quantity), 2) as intercept, "
        "round(regr_r2(l_extendedprice, l_quantity), 6) as r2 from lineitem"
    ),
    "popularity_trend": with_views(
        "select count(*) as n, round(regr_slope(avg_rating, popularity), 9) as slope, "
        "round(regr_intercept(avg_rating, popularity), 6) as intercept, "
        f"round(regr_r2(avg_rating, popularity), 6) as r2 from ({_POPULARITY_RATING}) x",
        "person",
        "known_for",
        "rating",
    ),
    "box_stats": (
        "with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, "
        "quantile_cont(l_extendedprice, 0.5) as med, quantile_cont(l_extendedprice, 0.75) as q3 from lineitem group by 1) "
        "select l_returnflag, round(q1, 4) as q1, round(med, 4) as median, round(q3, 4) as q3, "
        "round(least(q1, min(l_extendedprice) filter (where l_extendedprice >= q1 - 1.5 * (q3 - q1))), 4) as whisker_low, "
        "round(greatest(q3, max(l_extendedprice) filter (where l_extendedprice <= q3 + 1.5 * (q3 - q1))), 4) as whisker_high, "
        "count(*) filter (where l_extendedprice < q1 - 1.5 * (q3 - q1) or l_extendedprice > q3 + 1.5 * (q3 - q1)) as outliers, "
        "count(*) as n from lineitem join q using (l_returnflag) group by l_returnflag, q1, med, q3"
    ),
    "histogram": (
        "with s as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi, (max(l_extendedprice) - min(l_extendedprice)) / 30 as w from lineitem), "
        "c as (select least(cast(floor((l_extendedprice - lo) / w) as int), 29) as bin, count(*) as n from lineitem, s group by 1) "
        "select cast(b.bin as int) as bin, round(lo + b.bin * w, 3) as bin_low, round(lo + (b.bin + 1) * w, 3) as bin_high, "
        "coalesce(n, 0) as n from range(30) b(bin) cross join s left join c on c.bin = b.bin"
    ),
    "histogram_nan": (
        "with t as (select l_extendedprice as v from lineitem where l_orderkey % 7 <> 0 and l_orderkey % 11 <> 0), "
        "s as (select min(v) as lo, max(v) as hi, (max(v) - min(v)) / 30 as w from t), "
        "c as (select least(cast(floor((v - lo) / w) as int), 29) as bin, count(*) as n from t, s group by 1) "
        "select cast(b.bin as int) as bin, round(lo + b.bin * w, 3) as bin_low, round(lo + (b.bin + 1) * w, 3) as bin_high, "
        "coalesce(n, 0) as n from range(30) b(bin) cross join s left join c on c.bin = b.bin"
    ),
    "truncate_label": (
        "select doc_id, case when length(text) > 30 then substr(text, 1, 30) || '...' else text end as label, "
        "lang || ' & ' || source as pair from documents"
    ),
}
