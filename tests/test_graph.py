"""Mapping, entailment and patterns on golden rows."""

import pytest
from pyspark.sql import functions as F

from kinomill.operators import bgp as B
from kinomill.operators import triples as T
from kinomill.plans import analytics as A
from kinomill.plans import domain as D
from kinomill.plans import graph_model as M
from kinomill.sources import readers, sinks

V = M.Vocabulary("http://example.org/t/")
P = V.term


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(
        [
            ("nm1", "Ann", 1950, None, ["director", "writer", "actor"], ["tt1", "tt2"]),
            ("nm2", None, None, None, None, ["tt1"]),
            ("nm3", "Cy", None, 1990, [], ["tt1"]),
            ("xx4", "Foreign", None, None, ["actor"], ["tt1"]),
        ],
        "nconst string, primaryName string, birthYear int, deathYear int, primaryProfession array<string>, knownForTitles array<string>",
    )


def test_names(names):
    g = M.graph({"name_basics": names}, V)
    found = {(r.s.removeprefix(V.namespace), r.p.removeprefix(V.namespace), r.o.removeprefix(V.namespace)) for r in g.collect()}
    assert ("Person/nm1", "primary_profession", "Profession/director") in found
    assert {o for s, p, o in found if p == "alternative_profession"} == {"Profession/writer", "Profession/actor"}
    assert {s for s, p, _ in found if p == "isKnownfor"} == {"Person/nm1"}
    assert not [f for f in found if "xx4" in f[0]]
    assert not [f for f in found if f[0] == "Person/nm2" and f[1] == "name"]


def test_set_semantics_and_null_values(spark):
    ratings = spark.createDataFrame(
        [("u", "tt1", 7, "2020-01-01 00:00:00"), ("u", "tt1", 7, "2020-01-01 00:00:00"), ("u", "tt1", 9, None), ("u", "tt1", None, None), ("v", "x", 3, None)],
        "user_id string, movie_id string, rating int, rating_timestamp string",
    )
    g = M.graph({"ratings": ratings}, V)
    scores = T.property_table(g, P("rating_score"), cast="int").collect()
    assert sorted(r.o for r in scores) == [7, 9]
    assert len({r.s for r in scores}) == 1
    assert [r.o for r in T.property_table(g, P("rating_date")).collect()] == ["2020-01-01T00:00:00"]
    assert g.count() == g.distinct().count()
    twice = M.graph({"ratings": ratings.unionByName(ratings)}, V)
    assert twice.exceptAll(g).count() == 0 and g.exceptAll(twice).count() == 0


def test_bad_genre_does_not_cost_the_row(spark):
    movies = spark.createDataFrame([("tt1", "A", ["\\N", "Sci Fi", None, ""])], "movie_id string, movie_title string, genres array<string>")
    g = M.graph({"movies": movies}, V)
    assert {r.o for r in g.where(F.col("p") == P("has_genre")).collect()} == {P("Genre/%5CN"), P("Genre/Sci%20Fi")}
    assert g.where(F.col("p") == P("title")).count() == 1


def test_one_node_for_two_roles(spark):
    crew = spark.createDataFrame([("tt1", ["nm1"], ["nm1", "nm2"]), ("tt2", None, [])], "tconst string, directors array<string>, writers array<string>")
    g = M.graph({"title_crew": crew}, V)
    nodes = T.instances(g, P("Participates")).collect()
    assert len(nodes) == 2
    roles = g.where((F.col("p") == P("participates_role")) & F.col("s").endswith("nm1_tt1")).collect()
    assert {r.o for r in roles} == {P("Profession/director"), P("Profession/writer")}


def test_one_scan_per_source_and_entailment_without_join(spark, small):
    """Types straight from the codes equal those derived from the finished statements."""
    from kinomill.catalog import graph as catalog

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for name in ("movies", "title_basics"):
        assert plan(M.graph({name: catalog._TABLES[name](spark, small)}, V)).count("FileScan") == 1
    tables = {name: catalog._TABLES[name](spark, small) for name in ("movies", "title_basics")}
    direct = M.entailed(tables, V)
    assert "Join" not in plan(direct)
    derived = T.entail_types(M.graph(tables, V), V.schema(spark))
    assert direct.exceptAll(derived).count() == derived.exceptAll(direct).count() == 0


def test_entailment(spark):
    t = spark.createDataFrame(
        [("a", P("has_genre"), "g", "iri", None), ("b", P("title"), "T", "literal", M.XSD + "string"), ("c", "other", "d", "iri", None)],
        "s string, p string, o string, o_kind string, o_type string",
    )
    derived = T.entail_types(t, V.schema(spark))
    assert {(r.s, r.o) for r in derived.collect()} == {("a", P("Movie")), ("g", P("Genre")), ("b", P("Movie"))}
    closed = T.with_entailed(t, V.schema(spark))
    assert T.with_entailed(closed, V.schema(spark)).count() == closed.count() == 6
    assert len(M.PROPERTIES) == 27 and V.classes(spark).count() == 8


def test_patterns(spark):
    rows = [("m1", "year", "1"), ("m1", "year", "2"), ("m2", "year", "3"), ("m1", "genre", "g"), ("m2", "genre", "h"), ("g", "name", "G"), ("x", "self", "x"), ("x", "self", "y")]
    t = spark.createDataFrame(rows, "s string, p string, o string")
    star = B.bgp(t, [("?m", "year", "?y"), ("?m", "genre", "?g"), ("?g", "name", "?n")])
    assert sorted((r.m, r.y, r.n) for r in star.collect()) == [("m1", "1", "G"), ("m1", "2", "G")]
    only = B.bgp(t, [("?m", "year", "?y"), ("?m", "genre", "g")])
    assert sorted(r.y for r in only.collect()) == ["1", "2"]
    assert [r.a for r in B.bgp(t, [("?a", "self", "?a")]).collect()] == ["x"]
    assert sorted({r.p for r in B.bgp(t, [("m1", "?p", "?o")]).collect()}) == ["genre", "year"]
    with pytest.raises(ValueError, match="cross join"):
        B.bgp(t, [("?a", "year", "?b"), ("?c", "genre", "?d")])


def test_join_order_follows_constants_and_links():
    patterns = [("?a", "p", "?b"), ("?c", "q", "?a"), ("?c", "type", "K")]
    assert B.join_order(patterns) == [patterns[2], patterns[1], patterns[0]]


def test_graph_and_property_tables_agree(spark, small, rows):
    names = D.name_basics(spark, small).withColumnRenamed("nconst", "n").select(
        F.col("n").alias("nconst"), "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"
    )
    g = M.graph({"crew_data": D.crew_data(spark, small), "name_basics": names}, V)
    solved = B.bgp(
        g,
        [
            ("?person", M.RDF_TYPE, P("Person")),
            ("?person", P("gender"), "?gender"),
            ("?person", P("primary_profession"), "?job"),
            ("?job", P("profession_name"), "?profession"),
        ],
    )
    by_graph = solved.groupBy("profession", "gender").agg(F.count(F.lit(1)).alias("n"))
    credited = D.known_for(spark, small).select("person_id").distinct()
    people = D.person(spark, small).join(credited, "person_id", "left_semi")
    by_table = A.profession_gender(people.select("person_id", "profession"), people.select("person_id", "gender"))
    assert rows(by_graph, "profession", "gender", "n") == rows(by_table, "profession", "gender", "n")


def test_genre_rating_over_the_graph(spark, small, rows):
    g = M.graph({"ratings": D.ratings(spark, small), "movies": D.movies(spark, small)}, V).cache()
    solved = B.bgp(
        g,
        [
            ("?movie", P("has_genre"), "?genre"),
            ("?genre", P("genre_name"), "?name"),
            ("?rating", P("rating_movie"), "?movie"),
            ("?rating", P("rating_score"), "?score"),
        ],
    )
    by_graph = solved.groupBy(F.col("name").alias("genre")).agg(F.round(F.avg(F.col("score").cast("int")), 6).alias("r"))
    by_table = A.genre_rating(D.movie_genre(spark, small), D.rating(spark, small))
    assert rows(by_graph, "genre", "r") == rows(by_table.select("genre", F.round("avg_rating", 6).alias("r")), "genre", "r")


def test_stored_by_predicate_is_pruned(spark, tmp_path):
    movies = spark.createDataFrame([("tt1", "A", ["x"])], "movie_id string, movie_title string, genres array<string>")
    sinks.write_triples(M.graph({"movies": movies}, V), str(tmp_path / "g"))
    table = T.property_table(spark.read.parquet(str(tmp_path / "g")), P("title"))
    assert [r.o for r in table.collect()] == ["A"]
    plan = table._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_ntriples_lines(spark, tmp_path):
    t = spark.createDataFrame(
        [("s", "p", 'a "q" \\ \n\t', "literal", "T"), ("s", "p", "o", "iri", None)], "s string, p string, o string, o_kind string, o_type string"
    )
    for _ in range(2):
        sinks.write_ntriples(t, str(tmp_path / "nt"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "nt")).collect())
    assert lines == ['<s> <p> "a \\"q\\" \\\\ \\n\\t"^^<T> .', "<s> <p> <o> ."]


def test_index_file(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("id\tentity\n0\thttp://x/Movie/tt1\n1\thttp://x/Person/nm1\n")
    index = readers.read_entity_index(spark, str(tmp_path / "e.tsv"))
    assert [tuple(r) for r in readers.entities_of_kind(index, "Movie").collect()] == [(0, "http://x/Movie/tt1")]


def test_pruned_collaborations_are_exact(spark):
    """One movie has most of the credits; repeated pairs sit elsewhere."""
    rows = [(f"nm{i}", "hot", role) for i in range(60) for role in ("director", "writer")]
    rows += [(f"nm{i}", f"tt{i}_{j}", "director") for i in range(30) for j in range(i % 5 + 1)]
    rows += [(f"nm{100 + i}", f"tt{i}_{j}", "writer") for i in range(30) for j in range(i % 5 + 1)]
    crew = spark.createDataFrame(rows, "person_id string, movie_id string, role string")
    people = crew.select("person_id").distinct()
    named = people.select("person_id", F.concat(F.lit("name"), F.substring("person_id", -2, 2)).alias("name"))
    got = [tuple(r) for r in A.collaborations(crew, named, 12).collect()]
    who = {r.person_id: r.name for r in named.collect()}
    counts = {}
    for d, m, role in rows:
        for w, m2, role2 in rows:
            if m == m2 and role == "director" and role2 == "writer" and d != w:
                counts[who[d], who[w]] = counts.get((who[d], who[w]), 0) + 1
    wanted = sorted(((n, -c) for n, c in counts.items()), key=lambda x: (x[1], x[0]))[:12]
    assert got == [(d, w, -c) for (d, w), c in wanted]


def test_pattern_filters_and_implied_types(spark):
    t = spark.createDataFrame([("a", "year", "1"), ("b", "year", "2"), ("a", "likes", "b"), ("b", "likes", "a")], "s string, p string, o string")
    patterns = [("?x", "type", "Film"), ("?x", "likes", "?y"), ("?x", "year", "?n"), ("?y", "year", "?m")]
    needed = B.without_implied(patterns, {"year": "Film"}, "type")
    assert needed == patterns[1:]
    found = B.bgp(t, needed, [(("?n", "?m"), F.col("n") < F.col("m"))])
    assert [r.asDict() for r in found.collect()] == [{"x": "a", "y": "b", "n": "1", "m": "2"}]
    with pytest.raises(ValueError, match="unbound"):
        B.bgp(t, needed, [(("?z",), F.col("z") > 1)])


def test_films_of_one_split_are_mapped_by_several_tasks(spark, small):
    """Millions of films are one split; each gives a dozen statements, which one task would have to merge."""
    from kinomill.catalog import graph

    for key in ("triples_movie", "triples_title", "property_table"):
        made = graph.QUERIES[key](spark, small) if key != "property_table" else graph.M.graph({"title_basics": graph.D.title_basics(spark, small)}, graph.V)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" in plan[plan.index("Generate") :]


def test_rows_of_a_mapping_task_do_not_grow_with_the_tables(spark, small, rows, monkeypatch):
    """Many rows are dealt by their number, also behind joins, whose coalesced tasks are cut by bytes; the statements stay the same."""
    from kinomill.catalog import graph as queries

    assert D.mapping_tasks(spark, small, "ratings") is None
    keys = ("entail_types", "triples_name", "triples_title")
    few = {key: rows(queries.QUERIES[key](spark, small)) for key in keys}
    monkeypatch.setattr(D, "ROWS_A_TASK", {"lineitem": 100, "part": 5})
    for key, source in zip(keys, ("lineitem", "lineitem", "part")):
        table = D.table(spark, small, source).count()
        tasks = D.mapping_tasks(spark, small, "ratings" if source == "lineitem" else "title_basics")
        assert tasks == -(-table // D.ROWS_A_TASK[source]) > spark.sparkContext.defaultParallelism
        dealt = queries.QUERIES[key](spark, small)
        assert f"RoundRobinPartitioning({tasks})" in dealt._jdf.queryExecution().executedPlan().toString()
        assert rows(dealt) == few[key]
