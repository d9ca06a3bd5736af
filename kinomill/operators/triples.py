"""Rows to statements (s, p, o, o_kind, o_type) with set semantics, and back to tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("s", "p", "o", "o_kind", "o_type")
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


@dataclass(frozen=True)
class Term:
    """Subject or object: a constant prefix and a part that depends on the row."""

    prefix: str
    part: Column


@dataclass(frozen=True)
class Statement:
    """One statement per row; left out if the guard fails or a part is NULL."""

    subject: Term
    predicate: str
    object: Term
    kind: str
    type: str | None
    guard: Column | None = None

    def constants(self) -> tuple:
        return self.subject.prefix, self.predicate, self.object.prefix, self.kind, self.type


Part = tuple[DataFrame, Sequence[Statement]]


def map_triples(parts: Sequence[Part]) -> DataFrame:
    """All statements of all parts, as a set; one pass over each part.

    No row is lost for one bad value. Parts shared by several statements are
    projected once, ahead of the array that is unnested. Everything constant
    about a statement travels as one small number until the copies are merged,
    which keeps the shuffle to that number and the two variable parts. Prefixes
    end where the encoded parts start, so equal statements have equal codes.
    """
    codes: dict[tuple, int] = {}
    coded = [_coded(df, statements, codes) for df, statements in parts]
    merged = reduce(lambda a, b: a.unionByName(b), coded).distinct()
    subjects, predicates, objects, kinds, types = zip(*codes)

    def looked_up(values):
        return F.array(*[F.lit(v).cast("string") for v in values])[F.col("code")]

    return merged.select(
        F.concat(looked_up(subjects), F.col("s")).alias("s"),
        looked_up(predicates).alias("p"),
        F.concat(looked_up(objects), F.col("o")).alias("o"),
        looked_up(kinds).alias("o_kind"),
        looked_up(types).alias("o_type"),
    )


def map_entailed(parts: Sequence[Part], schema: Sequence[tuple[str, str | None, str | None]]) -> DataFrame:
    """Types that follow for the statements of all parts from (property, domain, range).

    The code of a statement fixes its property, so what follows from it is a
    constant: no join, and only (class code, variable part) is shuffled.
    """
    codes: dict[tuple, int] = {}
    coded = [_coded(df, statements, codes) for df, statements in parts]
    rules = {p: (domain, range_) for p, domain, range_ in schema}
    derived: dict[tuple[str, str], int] = {}
    follow = []
    for subject, predicate, target, kind, _ in codes:
        domain, range_ = rules.get(predicate, (None, None))
        here = [(derived.setdefault((subject, domain), len(derived)), False)] if domain else []
        if range_ and kind == "iri":
            here.append((derived.setdefault((target, range_), len(derived)), True))
        made = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(of_object).alias("of_object")) for d, of_object in here])
        follow.append(made.cast("array<struct<d:int,of_object:boolean>>"))
    if not derived:
        raise ValueError("no statement uses a property of the schema")
    merged = reduce(lambda a, b: a.unionByName(b), coded)
    each = merged.select("s", "o", F.inline(F.array(*follow)[F.col("code")]))
    pairs = each.select("d", F.when(F.col("of_object"), F.col("o")).otherwise(F.col("s")).alias("part")).distinct()

    def looked_up(values):
        return F.array(*[F.lit(v) for v in values])[F.col("d")]

    prefixes, classes = zip(*derived)
    return _typed(pairs.select(F.concat(looked_up(prefixes), F.col("part")).alias("s"), looked_up(classes).alias("o")))


def _typed(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "s", F.lit(RDF_TYPE).alias("p"), "o", F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_type")
    )


def _coded(df: DataFrame, statements: Sequence[Statement], codes: dict) -> DataFrame:
    terms: dict[int, tuple[str, Column]] = {}

    def term(column: Column) -> Column:
        name, _ = terms.setdefault(id(column), (f"__c{len(terms)}", column))
        return F.col(name)

    made = []
    for st in statements:
        code = codes.setdefault(st.constants(), len(codes))
        subject, value = term(st.subject.part), term(st.object.part)
        wanted = subject.isNotNull() & value.isNotNull()
        if st.guard is not None:
            wanted = term(st.guard) & wanted
        made.append(F.when(wanted, F.struct(F.lit(code).alias("code"), subject.alias("s"), value.alias("o"))))
    projected = df.select(*[column.alias(name) for name, column in terms.values()])
    return projected.select(F.inline(F.array(*made))).where("s is not null")


def to_triples(df: DataFrame, statements: Sequence[Statement]) -> DataFrame:
    return map_triples([(df, statements)])


def distinct_triples(*parts: DataFrame) -> DataFrame:
    """Union of ready statements as a set. Copies are merged before the shuffle."""
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def entail_types(triples: DataFrame, schema: DataFrame) -> DataFrame:
    """Types that follow from property domains and ranges, for statements at hand.

    ``schema`` (property, domain, range) may be of any size; Spark broadcasts it if it is small.
    Statements that are still to be mapped need no join: ``map_entailed``.
    """
    typed = triples.join(schema, F.col("p") == F.col("property"))
    derived = F.array(
        F.when(F.col("domain").isNotNull(), F.struct(F.col("s").alias("s"), F.col("domain").alias("o"))),
        F.when(
            (F.col("o_kind") == "iri") & F.col("range").isNotNull(),
            F.struct(F.col("o").alias("s"), F.col("range").alias("o")),
        ),
    )
    return _typed(typed.select(F.inline(derived)).where("s is not null").distinct())


def with_entailed(triples: DataFrame, schema: DataFrame) -> DataFrame:
    return distinct_triples(triples, entail_types(triples, schema))


def property_table(triples: DataFrame, predicate: str, subject: str = "s", value: str = "o", cast: str = "string") -> DataFrame:
    """Subjects and values of one predicate; reads one folder of a table written by predicate."""
    return triples.where(F.col("p") == predicate).select(
        F.col("s").alias(subject), F.col("o").try_cast(cast).alias(value)
    )


def instances(triples: DataFrame, class_iri: str, alias: str = "s") -> DataFrame:
    return triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == class_iri)).select(F.col("s").alias(alias))
