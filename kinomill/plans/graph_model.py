"""Vocabulary of the graph and the mapping of each trusted table to statements."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import canonical_ts, iri_part
from ..operators.triples import Part, Statement, Term, map_entailed, map_triples

DEFAULT_NAMESPACE = "http://example.org/kg/"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

# Classes of the model.
CLASSES = ("Movie", "Person", "User", "Rating", "Genre", "Profession", "Known_for", "Participates")

# Property, domain, range. A range in lower case is an XSD type.
PROPERTIES = (
    ("movieId", "Movie", "string"),
    ("title", "Movie", "string"),
    ("isAdult", "Movie", "boolean"),
    ("startYear", "Movie", "integer"),
    ("runtime", "Movie", "integer"),
    ("userId", "User", "string"),
    ("personId", "Person", "string"),
    ("gender", "Person", "string"),
    ("name", "Person", "string"),
    ("popularity", "Person", "float"),
    ("deathYear", "Person", "integer"),
    ("birthYear", "Person", "integer"),
    ("genre_name", "Genre", "string"),
    ("rating_date", "Rating", "dateTime"),
    ("rating_score", "Rating", "integer"),
    ("known_for_popularity", "Known_for", "float"),
    ("profession_name", "Profession", "string"),
    ("participates_person", "Participates", "Person"),
    ("participates_role", "Participates", "Profession"),
    ("participates_movie", "Participates", "Movie"),
    ("primary_profession", "Person", "Profession"),
    ("alternative_profession", "Person", "Profession"),
    ("isKnownfor", "Person", "Known_for"),
    ("known_for_movie", "Known_for", "Movie"),
    ("has_genre", "Movie", "Genre"),
    ("rating_movie", "Rating", "Movie"),
    ("rates_movie", "User", "Rating"),
)


@dataclass(frozen=True)
class Vocabulary:
    """Builds IRIs and statements in one namespace."""

    namespace: str = DEFAULT_NAMESPACE

    def term(self, name: str) -> str:
        return self.namespace + name

    def range_of(self, name: str) -> str:
        kind = next(r for p, _, r in PROPERTIES if p == name)
        return self.term(kind) if kind in CLASSES else XSD + kind

    def schema(self, spark: SparkSession) -> DataFrame:
        rows = [(self.term(p), self.term(d), self.range_of(p)) for p, d, _ in PROPERTIES]
        return spark.createDataFrame(rows, "property string, domain string, range string")

    def classes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.term(c), c) for c in CLASSES], "class string, label string")

    def entity(self, kind: str, *ids: Column) -> Term:
        encoded = [iri_part(i.cast("string")) for i in ids]
        joined = encoded[0]
        for part in encoded[1:]:
            joined = F.concat(joined, F.lit("_"), part)
        return Term(self.term(kind) + "/", joined)

    def a(self, subject: Term, kind: str, guard: Column | None = None) -> Statement:
        return Statement(subject, RDF_TYPE, Term(self.term(kind), F.lit("")), "iri", None, guard)

    def value(self, subject: Term, name: str, value: Column, guard: Column | None = None) -> Statement:
        return Statement(subject, self.term(name), Term("", value.cast("string")), "literal", self.range_of(name), guard)

    def link(self, subject: Term, name: str, target: Term, guard: Column | None = None) -> Statement:
        return Statement(subject, self.term(name), target, "iri", None, guard)


def person_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    """Popularity table. The person's ``adult`` flag becomes the movie's ``isAdult``, as mapped upstream."""
    person, movie = v.entity("Person", F.col("imdb_id")), v.entity("Movie", F.col("known_for"))
    known = v.entity("Known_for", F.col("imdb_id"), F.col("known_for"))
    is_movie = F.col("known_for").startswith("tt")
    statements = [
        v.a(person, "Person"),
        v.value(person, "personId", F.col("imdb_id")),
        v.value(person, "name", F.col("name")),
        v.value(person, "gender", F.col("gender")),
        v.value(person, "popularity", F.col("popularity")),
        v.a(movie, "Movie", is_movie),
        v.value(movie, "isAdult", F.col("adult"), is_movie),
        v.a(known, "Known_for", is_movie),
        v.link(person, "isKnownfor", known, is_movie),
        v.link(known, "known_for_movie", movie, is_movie),
        v.value(known, "known_for_popularity", F.col("known_for_popularity"), is_movie),
    ]
    return [(df.where(F.col("imdb_id").startswith("nm")), statements)]


def rating_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    user, movie = v.entity("User", F.col("user_id")), v.entity("Movie", F.col("movie_id"))
    rating = v.entity("Rating", F.col("user_id"), F.col("movie_id"))
    is_movie = F.col("movie_id").startswith("tt")
    rated = is_movie & F.col("rating").isNotNull()
    moment = F.replace(canonical_ts(F.col("rating_timestamp")), F.lit(" "), F.lit("T"))
    statements = [
        v.a(user, "User"),
        v.value(user, "userId", F.col("user_id")),
        v.a(movie, "Movie", is_movie),
        v.a(rating, "Rating", rated),
        v.value(rating, "rating_date", moment, rated),
        v.value(rating, "rating_score", F.col("rating"), rated),
        v.link(rating, "rating_movie", movie, rated),
        v.link(user, "rates_movie", rating, rated),
    ]
    return [(df, statements)]


def itemised(df: DataFrame, *arrays: str) -> DataFrame:
    """Each row once for itself (kind -1) and once per element of its arrays: ``item`` (kind, pos, value).

    Kinds are numbered as the arrays are given. One pass over the rows serves
    the statements about a row and those about its elements.
    """
    kind = "array<struct<kind:int,pos:int,value:string>>"

    def elements(number: int, name: str) -> Column:
        made = F.transform(
            name, lambda x, i: F.struct(F.lit(number).alias("kind"), i.cast("int").alias("pos"), x.cast("string").alias("value"))
        )
        return F.coalesce(made.cast(kind), F.array().cast(kind))

    itself = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("value"))).cast(kind)
    return df.select("*", F.explode(F.concat(itself, *[elements(i, a) for i, a in enumerate(arrays)])).alias("item"))


def _kind(number: int) -> Column:
    return F.col("item.kind") == number


def _genres(movie: Term, v: Vocabulary) -> list[Statement]:
    """Statements of the elements of the first array."""
    value = F.col("item.value")
    genre, named = v.entity("Genre", value), _kind(0) & (value != "")
    return [v.a(genre, "Genre", named), v.value(genre, "genre_name", value, named), v.link(movie, "has_genre", genre, named)]


def movie_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    known = itemised(df.where(F.col("movie_id").startswith("tt")), "genres")
    movie, row = v.entity("Movie", F.col("movie_id")), _kind(-1)
    statements = [
        v.a(movie, "Movie", row),
        v.value(movie, "title", F.col("movie_title"), row),
        v.value(movie, "movieId", F.col("movie_id"), row),
        *_genres(movie, v),
    ]
    return [(known, statements)]


def title_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    known = itemised(df.where(F.col("tconst").startswith("tt")), "genres")
    movie, row = v.entity("Movie", F.col("tconst")), _kind(-1)
    statements = [
        v.a(movie, "Movie", row),
        v.value(movie, "title", F.col("primaryTitle"), row),
        v.value(movie, "movieId", F.col("tconst"), row),
        v.value(movie, "startYear", F.col("startYear"), row),
        v.value(movie, "runtime", F.col("runtimeMinutes"), row),
        *_genres(movie, v),
    ]
    return [(known, statements)]


def name_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    """First profession is the primary one; known-for titles need one to exist."""
    known = itemised(df.where(F.col("nconst").startswith("nm")), "primaryProfession", "knownForTitles")
    person, value, row = v.entity("Person", F.col("nconst")), F.col("item.value"), _kind(-1)
    job, first = v.entity("Profession", value), F.col("item.pos") == 0
    titled = _kind(1) & (F.size("primaryProfession") > 0)
    movie, work = v.entity("Movie", value), v.entity("Known_for", F.col("nconst"), value)
    statements = [
        v.a(person, "Person", row),
        v.value(person, "personId", F.col("nconst"), row),
        v.value(person, "name", F.col("primaryName"), row),
        v.value(person, "birthYear", F.col("birthYear"), row),
        v.value(person, "deathYear", F.col("deathYear"), row),
        v.a(job, "Profession", _kind(0)),
        v.value(job, "profession_name", value, _kind(0)),
        v.link(person, "primary_profession", job, _kind(0) & first),
        v.link(person, "alternative_profession", job, _kind(0) & ~first),
        v.a(movie, "Movie", titled),
        v.a(work, "Known_for", titled),
        v.link(person, "isKnownfor", work, titled),
        v.link(work, "known_for_movie", movie, titled),
    ]
    return [(known, statements)]


def crew_parts(df: DataFrame, v: Vocabulary) -> list[Part]:
    """One Participates node per (person, movie), whatever the number of roles."""
    known = itemised(df.where(F.col("tconst").startswith("tt")), "directors", "writers")
    movie, who, credit = v.entity("Movie", F.col("tconst")), F.col("item.value"), ~_kind(-1) & F.col("item.value").isNotNull()
    person, node = v.entity("Person", who), v.entity("Participates", who, F.col("tconst"))
    job = v.entity("Profession", F.when(_kind(0), "director").otherwise("writer"))
    statements = [
        v.a(movie, "Movie", _kind(-1)),
        v.a(person, "Person", credit),
        v.a(node, "Participates", credit),
        v.a(job, "Profession", credit),
        v.link(node, "participates_role", job, credit),
        v.link(node, "participates_person", person, credit),
        v.link(node, "participates_movie", movie, credit),
    ]
    return [(known, statements)]


PARTS = {
    "crew_data": person_parts,
    "ratings": rating_parts,
    "movies": movie_parts,
    "name_basics": name_parts,
    "title_basics": title_parts,
    "title_crew": crew_parts,
}


def _parts(tables: dict[str, DataFrame], v: Vocabulary, tasks: Mapping[str, int | None]) -> list[Part]:
    """Parts of all tables; rows of a table with a number in ``tasks`` are dealt to so many tasks before they are mapped."""
    dealt = {name: df.repartition(n) if (n := tasks.get(name)) else df for name, df in tables.items()}
    return [part for name, df in dealt.items() for part in PARTS[name](df, v)]


def graph(tables: dict[str, DataFrame], v: Vocabulary = Vocabulary(), tasks: Mapping[str, int | None] = {}) -> DataFrame:
    """Statements of any of the six trusted tables, merged as one set."""
    return map_triples(_parts(tables, v, tasks))


def entailed(tables: dict[str, DataFrame], v: Vocabulary = Vocabulary(), tasks: Mapping[str, int | None] = {}) -> DataFrame:
    """Types that the model's domains and ranges give to the statements of the tables, straight from their codes."""
    schema = [(v.term(p), v.term(d), v.range_of(p)) for p, d, _ in PROPERTIES]
    return map_entailed(_parts(tables, v, tasks), schema)
