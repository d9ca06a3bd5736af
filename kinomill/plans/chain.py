"""The whole way: raw tables, formatted, trusted, a stored graph, property tables, the eight queries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bgp import bgp
from ..operators.triples import property_table
from ..sources.sinks import write_triples
from . import analytics as A
from . import formatted, trusted
from .graph_model import Vocabulary, graph

FORMATS = {
    "title_basics": formatted.format_title_basics,
    "title_crew": formatted.format_title_crew,
    "name_basics": formatted.format_name_basics,
    "movies": formatted.format_movies,
    "users": formatted.format_users,
    "ratings": formatted.format_ratings,
}


def format_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each raw table in the common model; ``people`` (payloads) needs ``links`` and gives ``crew_data``."""
    done = {name: FORMATS[name](df) for name, df in raw.items() if name in FORMATS}
    if "people" in raw:
        done["crew_data"] = formatted.format_crew_data(raw["people"], raw["links"])
    return done


def trust_all(tables: dict[str, DataFrame], as_of: date | str | None = None, **options) -> dict[str, trusted.Trusted]:
    return {name: trusted.trust(df, name, as_of=as_of, **options) for name, df in tables.items()}


def store_graph(spark: SparkSession, tables: dict[str, DataFrame], path: str, v: Vocabulary = Vocabulary()) -> DataFrame:
    """The statements of the trusted tables, written by predicate and read back. Users are part of the ratings' graph."""
    write_triples(graph({name: df for name, df in tables.items() if name != "users"}, v), path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Analyses:
    """The eight queries over a stored graph; ids are the parts of IRIs after the kind."""

    triples: DataFrame
    v: Vocabulary = Vocabulary()

    def _ids(self, df: DataFrame, **kinds: str) -> DataFrame:
        for column, kind in kinds.items():
            df = df.withColumn(column, F.replace(F.col(column), F.lit(self.v.term(kind) + "/"), F.lit("")))
        return df

    def _property(self, name: str, subject: str, kind: str, value: str, cast: str = "string") -> DataFrame:
        return self._ids(property_table(self.triples, self.v.term(name), subject, value, cast), **{subject: kind})

    def movie_year(self) -> DataFrame:
        return self._property("startYear", "movie_id", "Movie", "start_year", "int")

    def movie_title(self) -> DataFrame:
        return self._property("title", "movie_id", "Movie", "title")

    def names(self) -> DataFrame:
        return self._property("name", "person_id", "Person", "name")

    def gender(self) -> DataFrame:
        return self._property("gender", "person_id", "Person", "gender")

    def popularity(self) -> DataFrame:
        return self._property("popularity", "person_id", "Person", "popularity", "double")

    def movie_genre(self) -> DataFrame:
        found = bgp(self.triples, [("?movie_id", self.v.term("has_genre"), "?g"), ("?g", self.v.term("genre_name"), "?genre")])
        return self._ids(found.select("movie_id", "genre"), movie_id="Movie")

    def profession(self) -> DataFrame:
        job = [("?person_id", self.v.term("primary_profession"), "?j"), ("?j", self.v.term("profession_name"), "?profession")]
        return self._ids(bgp(self.triples, job).select("person_id", "profession"), person_id="Person")

    def rating(self) -> DataFrame:
        node = [("?r", self.v.term("rating_movie"), "?movie_id"), ("?r", self.v.term("rating_score"), "?score")]
        found = bgp(self.triples, node).select("movie_id", F.col("score").cast("int").alias("score"))
        return self._ids(found, movie_id="Movie")

    def known_for(self) -> DataFrame:
        work = [("?person_id", self.v.term("isKnownfor"), "?k"), ("?k", self.v.term("known_for_movie"), "?movie_id")]
        return self._ids(bgp(self.triples, work).select("person_id", "movie_id"), person_id="Person", movie_id="Movie")

    def participates(self) -> DataFrame:
        node = [
            ("?n", self.v.term("participates_person"), "?person_id"),
            ("?n", self.v.term("participates_movie"), "?movie_id"),
            ("?n", self.v.term("participates_role"), "?role"),
        ]
        found = bgp(self.triples, node).select("person_id", "movie_id", "role")
        return self._ids(found, person_id="Person", movie_id="Movie", role="Profession")

    def profession_gender(self) -> DataFrame:
        return A.profession_gender(self.profession(), self.gender())

    def genre_by_decade(self) -> DataFrame:
        return A.genre_by_decade(self.movie_year(), self.movie_genre())

    def collaborations(self) -> DataFrame:
        return A.collaborations(self.participates(), self.names())

    def popularity_vs_rating(self) -> DataFrame:
        return A.popularity_vs_rating(self.popularity(), self.known_for(), self.rating())

    def career_longevity(self) -> DataFrame:
        return A.career_longevity(self.names(), self.known_for(), self.movie_year())

    def genre_rating(self) -> DataFrame:
        return A.genre_rating(self.movie_genre(), self.rating())

    def top_rated(self) -> DataFrame:
        return A.top_rated(self.movie_title(), self.movie_genre(), self.rating())

    def popularity_distribution(self) -> DataFrame:
        return A.popularity_distribution(self.popularity(), self.profession())


def run(spark: SparkSession, raw: dict[str, DataFrame], path: str, as_of: date | str | None = None, v: Vocabulary = Vocabulary()) -> Analyses:
    """All steps from raw tables to the queries over the graph stored at ``path``."""
    clean = {name: done.clean for name, done in trust_all(format_all(raw), as_of).items()}
    return Analyses(store_graph(spark, clean, path, v), v)
