"""Registered queries: sources, incremental loads and sinks.

Each writes the driver's rows in a source format below the shared folder and
reads them back with the library's reader.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.triples import to_triples
from ..plans import domain as D
from ..plans import formatted
from ..plans import graph_model as M
from ..session import cut_lineage, scratch_path
from ..sources import incremental, readers, schemas, sinks
from ..sources.snapshots import SnapshotTable
from .graph import graph_sql, triples_title
from .views import movie, person, with_views


def _padded(key):
    return F.lpad(F.col(key).cast("string"), 7, "0")


def scan_delimited(spark, d):
    """Ratings as ``::`` text, read and formatted."""
    path = scratch_path(spark, "ratings")
    raw = D.ratings(spark, d).select(
        "user_id",
        F.substring("movie_id", 3, 20).alias("movie_id"),
        F.col("rating").cast("string").alias("rating"),
        F.unix_seconds(F.col("rating_timestamp").cast("timestamp")).cast("string").alias("rating_timestamp"),
    )
    sinks.write_delimited(raw, path)
    done = formatted.format_ratings(readers.read_delimited(spark, path, schemas.RATINGS))
    return done.withColumn("rating_timestamp", F.col("rating_timestamp").cast("timestamp_ntz"))


def scan_tsv_gz(spark, d):
    """Titles as gzip TSV with backslash markers, read and formatted."""
    path = scratch_path(spark, "titles")
    key = F.col("p_partkey")
    raw = D.table(spark, d, "part").select(
        D.movie_id("p_partkey").alias("tconst"),
        F.lit("movie").alias("titleType"),
        F.concat(F.lit(' Ünïted "'), "p_name", F.lit("  end")).alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        (key % 2).cast("string").alias("isAdult"),
        F.when(key % 9 == 0, "\\N").otherwise((1950 + F.col("p_size")).cast("string")).alias("startYear"),
        F.lit("\\N").alias("endYear"),
        F.col("p_size").cast("string").alias("runtimeMinutes"),
        F.when(key % 4 == 0, "\\N").otherwise(F.concat("p_type", F.lit(","), "p_brand")).alias("genres"),
    )
    sinks.write_tsv_gz(raw, path)
    read = readers.read_tsv_gz(spark, path, schemas.TITLE_BASICS, partitions=8)
    return formatted.format_title_basics(read).withColumn("genres", F.array_join("genres", "|"))


def _links(spark, d):
    return D.table(spark, d, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        _padded("p_partkey").alias("imdbId"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).alias("tmdbId"),
    )


def scan_csv(spark, d):
    path = scratch_path(spark, "links")
    sinks.write_csv(_links(spark, d), path)
    return readers.read_csv(spark, path, schemas.LINKS)


def scan_json_map(spark, d):
    """Person payloads keyed by id; every tenth is null. Formatted with the links."""
    path = scratch_path(spark, "people")
    key = F.col("s_suppkey")
    known_for = F.array(
        F.struct(key.cast("int").alias("id"), (F.col("s_acctbal") / 4).alias("popularity")),
        F.struct((key + 1_000_000).cast("int").alias("id"), F.lit(1.5).alias("popularity")),
    )
    body = F.struct(
        key.cast("int").alias("id"),
        F.concat(F.lit("Zoë  "), "s_name").alias("name"),
        F.lit("N/A").alias("original_name"),
        F.lit("person").alias("media_type"),
        (key % 17 == 0).alias("adult"),
        F.col("s_acctbal").alias("popularity"),
        (F.col("s_nationkey") % 4).cast("int").alias("gender"),
        F.lit("Acting").alias("known_for_department"),
        known_for.alias("known_for"),
    )
    payload = F.struct(D.person_id("s_suppkey").alias("imdb_id"), body.alias("tmdb_data"))
    entry = F.create_map(D.person_id("s_suppkey"), F.when(key % 10 != 0, payload))
    lines = D.table(spark, d, "supplier").select(F.to_json(entry, {"ignoreNullFields": "false"}).alias("value"))
    lines.write.mode("overwrite").text(path)
    people = readers.read_json_map(spark, path, schemas.PERSON_PAYLOAD, layout="lines")
    return formatted.format_crew_data(people, _links(spark, d)).select(
        "imdb_id", "tmdb_id", "name", "original_name", "adult", "popularity", "gender", "known_for", "known_for_popularity"
    )


def scan_parquet(spark, d):
    """Zone table: only the read columns and matching row groups are loaded."""
    root = scratch_path(spark, "lake")
    sinks.write_zone(D.table(spark, d, "orders"), root, "formatted", "orders")
    orders = readers.read_zone(spark, root, "formatted", "orders")
    return orders.where("o_totalprice >= 300000").select("o_orderkey", "o_totalprice", "o_orderdate")


def sink_parquet(spark, d):
    """Overwriting twice leaves one copy."""
    root = scratch_path(spark, "lake")
    events = D.table(spark, d, "events")
    sinks.write_zone(events, root, "trusted", "events")
    sinks.write_zone(events, root, "trusted", "events")
    return readers.read_zone(spark, root, "trusted", "events")


def scan_triples_tsv(spark, d):
    path = scratch_path(spark, "triples")
    sinks.write_triples_tsv(triples_title(spark, d), path)
    return readers.read_triples(spark, path)


def sink_triples_tsv(spark, d):
    """Credits as subject, role, object lines."""
    path = scratch_path(spark, "edges")
    edges = D.participates(spark, d).select(F.col("person_id").alias("s"), F.col("role").alias("p"), F.col("movie_id").alias("o"))
    sinks.write_triples_tsv(edges, path)
    return readers.read_triples(spark, path)


def sink_triples_tsv_text(spark, d):
    """Whole texts with tabs and line breaks as objects come back unchanged."""
    path = scratch_path(spark, "texts")
    docs = D.table(spark, d, "documents")
    triples = docs.select(F.col("doc_id").cast("string").alias("s"), F.lit("text\\of").alias("p"), F.col("text").alias("o"))
    sinks.write_triples_tsv(triples, path)
    back = readers.read_triples(spark, path)
    return back.select(F.col("s").cast("bigint").alias("doc_id"), "p", F.col("o").alias("text"))


def entity_index(spark, d):
    """Index file with a header and foreign lines, numeric ids kept."""
    path = scratch_path(spark, "index")
    key = F.col("p_partkey")
    rows = D.table(spark, d, "part").select(
        F.when(key % 8 == 0, "id").otherwise(key.cast("string")).alias("id"), D.movie_id("p_partkey").alias("entity")
    )
    rows.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)
    return readers.read_entity_index(spark, path)


def changed_files(spark, d):
    """Documents whose text hash differs from the manifest's or is not in it."""
    docs = D.table(spark, d, "documents").select(F.col("doc_id").alias("path"), F.md5("text").alias("md5"), "text", "lang")
    manifest = docs.where("lang != 'de'").select(
        "path", F.when(F.col("lang") == "fr", F.md5(F.concat("text", F.lit("old")))).otherwise(F.col("md5")).alias("md5")
    )
    return incremental.changed(docs.select("path", "md5"), manifest)


# Documents of consecutive ids in one file; fixed, so that files stay what they are when documents are added.
FILE_ROWS = 1_000


def file_hashes(spark, d):
    """Stored texts of each language, source and range of ids, a file each, and the hashes of their whole content.

    All files are new at first, none once the manifest knows them.
    """
    path = scratch_path(spark, "files")
    # One short line per document; a file's lines are ordered and so its content is known.
    group = ["lang", "source", "part"]
    lines = D.table(spark, d, "documents").select(
        "lang", "source", F.floor(F.col("doc_id") / FILE_ROWS).cast("long").alias("part"),
        F.concat_ws(" ", F.lpad("doc_id", 12, "0"), F.md5("text")).alias("value"),
    )
    # The number is given: by size, files of a few lines each would all be written by one task, one after the other.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.repartition(tasks, *group).sortWithinPartitions(*group, "value").write.mode("overwrite").partitionBy(*group).text(path)
    nothing = spark.createDataFrame([], "path string, md5 string")
    # Kept: the manifest and the result would read and hash all files once more each.
    fresh = cut_lineage(incremental.changed_files(spark, path, nothing, pattern="part-*"))
    manifest = incremental.updated_manifest(nothing, fresh)
    left = incremental.changed_files(spark, path, manifest, pattern="part-*").agg(F.count(F.lit(1)).alias("n")).scalar()
    return fresh.select(
        F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang"),
        F.regexp_extract("path", "source=([^/]*)", 1).alias("source"),
        F.regexp_extract("path", "part=([^/]*)", 1).cast("long").alias("part"),
        "md5",
    ).withColumn("still_new", left)


def incremental_new_keys(spark, d):
    """Parts not yet sold on a loaded order; a NULL payload counts as not loaded."""
    candidates = D.table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    loaded = D.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("k"), F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("payload")
    )
    return incremental.new_keys(candidates, loaded, "k", "payload")


def incremental_append(spark, d):
    """Customer table after fetched rows replaced those without a balance."""
    customers = D.table(spark, d, "customer")
    stored = customers.where("c_mktsegment != 'MACHINERY'").select(
        "c_custkey", F.when(F.col("c_nationkey") > 4, F.col("c_acctbal")).alias("c_acctbal")
    )
    fetched = customers.where("c_mktsegment in ('MACHINERY', 'BUILDING')").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return incremental.append_new(stored, fetched, "c_custkey", "c_acctbal")


def referenced_people(spark, d):
    """People credited on movies with a top rating."""
    rated = D.rating(spark, d).where("score >= 10").select(F.substring("movie_id", 3, 20).alias("movie_id"))
    who = D.person_id("l_suppkey")
    crew = D.table(spark, d, "lineitem").select(
        D.movie_id("l_partkey").alias("tconst"),
        F.when(F.col("l_linenumber") == 1, F.concat(who, F.lit(",\\N"))).alias("directors"),
        F.when(F.col("l_linenumber") == 2, who).otherwise("").alias("writers"),
    )
    return incremental.referenced_people(rated, crew)


def shape_payload(spark, d):
    """Search results made of the events' JSON, reduced to the first hit."""
    work = "struct<id: bigint, popularity: double, overview: string>"
    result = f"array<struct<id: bigint, name: string, known_for: array<{work}>>>"
    k = F.get_json_object("props", "$.k")
    hit = F.concat(
        F.lit('[{"id":'), F.col("user_id").cast("string"), F.lit(',"name":"'), "event_type", F.lit('","known_for":[{"id":'), k,
        F.lit(',"popularity":2.5,"overview":"x"},null,{"id":7}]},{"id":-1}]'),
    )
    text = F.when(F.col("event_id") % 6 == 0, "[]").otherwise(hit)
    parsed = D.table(spark, d, "events").select(
        "event_id", incremental.shape_payload(F.from_json(text, result)).alias("person")
    )
    return parsed.select(
        "event_id",
        F.col("person.id").alias("id"),
        F.col("person.name").alias("name"),
        F.size("person.known_for").alias("works"),
        F.col("person.known_for")[0]["id"].alias("first_work"),
        F.col("person.known_for")[0]["popularity"].alias("first_popularity"),
    )


def zone_merge(spark, d):
    """A zone of customers after two merges: changed balances, and customers that come in anew."""
    table = SnapshotTable(spark, scratch_path(spark, "zone"), ("c_custkey",), buckets=16)
    customers = D.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    table.write(customers.where("c_nationkey <> 3"))
    table.merge(customers.where("c_nationkey in (2, 3)").withColumn("c_acctbal", F.round(F.col("c_acctbal") + 1, 2)))
    table.merge(customers.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.round(F.col("c_acctbal") - 1, 2)))
    table.expire()
    return table.read()


def storage_footprint(spark, d):
    """Bytes of the documents' ids and lengths as CSV, which are known to the byte, and as Parquet."""
    text, parquet = scratch_path(spark, "text"), scratch_path(spark, "parquet")
    docs = D.table(spark, d, "documents").select("doc_id", "n_chars")
    docs.write.mode("overwrite").csv(text)
    docs.write.mode("overwrite").parquet(parquet)
    found = sinks.footprint(spark, text, parquet)
    saved = F.round((1 - F.col("target_bytes") / F.col("source_bytes")) * 100, 1)
    return found.select(
        "source_bytes",
        # Two columns of numbers in Parquet: more than nothing, less than two plain longs a row and a footer per file.
        F.col("target_bytes").between(1, 16 * docs.count() + 1_000_000).alias("parquet_is_bounded"),
        (F.col("saved_percent") == saved).alias("share_follows"),
    )


def sink_ntriples(spark, d):
    """Statements as N-Triples lines, escapes included."""
    path = scratch_path(spark, "nt")
    docs = D.table(spark, d, "documents")
    v = M.Vocabulary()
    doc = v.entity("Movie", F.col("doc_id"))
    texts = to_triples(docs, [v.a(doc, "Movie"), v.value(doc, "title", F.col("text"))])
    sinks.write_ntriples(texts, path)
    return spark.read.text(path)


def sink_csv(spark, d):
    path = scratch_path(spark, "csv")
    sinks.write_csv(D.table(spark, d, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return readers.read_csv(spark, path, schema)


def observe_metrics(spark, d):
    """Row and id counts taken while writing."""
    path = scratch_path(spark, "observed")
    orders = D.table(spark, d, "orders")
    seen = sinks.write_observed(
        orders,
        path,
        rows=F.count(F.lit(1)),
        without_customer=F.count_if(F.col("o_custkey").isNull()),
        largest=F.max("o_totalprice"),
    )
    row = (seen["rows"], seen["without_customer"], seen["largest"])
    counted = spark.createDataFrame([row], "rows bigint, without_customer bigint, largest double")
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"))
    return counted.select("*", stored.scalar().alias("stored"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_delimited, scan_tsv_gz, scan_csv, scan_json_map, scan_parquet, scan_triples_tsv, entity_index,
        changed_files, file_hashes, incremental_new_keys, incremental_append, referenced_people, shape_payload,
        sink_parquet, zone_merge, storage_footprint, sink_ntriples, sink_csv, sink_triples_tsv, sink_triples_tsv_text, observe_metrics,
    )
}

def _triples_of_titles():
    body, views = graph_sql("triples_title")
    return with_views(f"select s, p, o from ({body}) t", *views)


_ESCAPED = "text"
for _plain, _escape in (("\\", "\\\\"), ('"', '\\"')):
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_escape}')"
for _code, _escape in ((10, "\\n"), (13, "\\r"), (9, "\\t")):
    _ESCAPED = f"replace({_ESCAPED}, chr({_code}), '{_escape}')"
_DOC = f"'<{M.DEFAULT_NAMESPACE}Movie/' || cast(doc_id as varchar) || '>'"

ORACLE = {
    "scan_delimited": with_views("select user_id, movie_id, rating, rating_timestamp from ratings", "ratings"),
    "scan_tsv_gz": f"select {movie('p_partkey')} as tconst, 'movie' as \"titleType\", "
    "'United \"' || p_name || ' end' as \"primaryTitle\", p_name as \"originalTitle\", p_partkey % 2 = 1 as \"isAdult\", "
    'case when p_partkey % 9 <> 0 then 1950 + p_size end as "startYear", cast(null as varchar) as "endYear", p_size as "runtimeMinutes", '
    "case when p_partkey % 4 <> 0 then p_type || '|' || p_brand end as genres from part",
    "scan_csv": "select cast(p_partkey as int) as \"movieId\", lpad(cast(p_partkey as varchar), 7, '0') as \"imdbId\", "
    'case when p_partkey % 2 = 0 then cast(p_partkey as varchar) end as "tmdbId" from part',
    "scan_json_map": f"select {person('s_suppkey')} as imdb_id, cast(s_suppkey as int) as tmdb_id, 'Zoe ' || s_name as name, "
    "cast(null as varchar) as original_name, s_suppkey % 17 = 0 as adult, s_acctbal as popularity, "
    "case s_nationkey % 4 when 0 then 'NotSet' when 1 then 'Female' when 2 then 'Male' else 'Non-binary' end as gender, "
    f"case when n = 0 and s_suppkey % 2 = 0 and exists (select 1 from part where p_partkey = s_suppkey) then {movie('s_suppkey')} "
    "when n = 0 then cast(s_suppkey as varchar) "
    "when (s_suppkey + 1000000) % 2 = 0 and exists (select 1 from part where p_partkey = s_suppkey + 1000000) "
    f"then {movie('s_suppkey + 1000000')} else cast(s_suppkey + 1000000 as varchar) end as known_for, "
    "case when n = 0 then s_acctbal / 4 else 1.5::double end as known_for_popularity from supplier cross join range(2) r(n) where s_suppkey % 10 <> 0",
    "scan_parquet": "select o_orderkey, o_totalprice, o_orderdate from orders where o_totalprice >= 300000",
    "sink_parquet": "select * from events",
    "scan_triples_tsv": _triples_of_titles(),
    "sink_triples_tsv": with_views("select person_id as s, role as p, movie_id as o from participates", "participates"),
    "sink_triples_tsv_text": "select doc_id, 'text\\of' as p, text from documents",
    "entity_index": f"select p_partkey as id, {movie('p_partkey')} as entity from part where p_partkey % 8 <> 0",
    "changed_files": "select doc_id as path, md5(text) as md5 from documents where lang in ('de', 'fr')",
    "file_hashes": f"select lang, source, doc_id // {FILE_ROWS} as part, md5(string_agg(lpad(doc_id::varchar, 12, '0') || ' ' || md5(text) || chr(10), '' order by doc_id)) as md5, "
    "0::bigint as still_new from documents group by lang, source, part",
    "incremental_new_keys": "select p_partkey as k from part where p_partkey not in (select l_partkey from lineitem where l_returnflag = 'R')",
    "incremental_append": "select c_custkey, case when c_mktsegment = 'MACHINERY' then c_acctbal + 1 "
    "when c_mktsegment = 'BUILDING' and c_nationkey <= 4 then c_acctbal + 1 when c_nationkey > 4 then c_acctbal end as c_acctbal from customer",
    "referenced_people": with_views(
        f"select distinct {person('l_suppkey')} as person_id from lineitem where l_linenumber in (1, 2) "
        f"and {movie('l_partkey')} in (select movie_id from rating where score >= 10)",
        "rating",
    ),
    "shape_payload": "select event_id, case when event_id % 6 <> 0 then user_id end as id, case when event_id % 6 <> 0 then event_type end as name, "
    "case when event_id % 6 <> 0 then 2 end as works, case when event_id % 6 <> 0 then cast(json_extract_string(props, '$.k') as bigint) end as first_work, "
    "case when event_id % 6 <> 0 then 2.5::double end as first_popularity from events",
    "zone_merge": "select c_custkey, c_nationkey, case when c_custkey % 10 = 0 then round(c_acctbal - 1, 2) "
    "when c_nationkey in (2, 3) then round(c_acctbal + 1, 2) else c_acctbal end as c_acctbal from customer",
    "storage_footprint": "select sum(length(doc_id::varchar) + length(n_chars::varchar) + 2)::bigint as source_bytes, "
    "true as parquet_is_bounded, true as share_follows from documents",
    "sink_ntriples": f"select {_DOC} || ' <{M.RDF_TYPE}> <{M.DEFAULT_NAMESPACE}Movie> .' as value from documents union all "
    f"select {_DOC} || ' <{M.DEFAULT_NAMESPACE}title> \"' || {_ESCAPED} || '\"^^<{M.XSD}string> .' from documents",
    "sink_csv": "select * from customer",
    "observe_metrics": "select count(*) as rows, count(*) filter (where o_custkey is null) as without_customer, "
    "max(o_totalprice) as largest, count(*) as stored from orders",
}
