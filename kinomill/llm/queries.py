"""The registered queries of the operators, over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from kinomill.llm import (
    bpe,
    exact_dedup,
    langid,
    lexical,
    merkle,
    mixing,
    pieces,
    quality,
    sharding,
    simhash,
    substring_dedup,
    topk,
    warc,
)
from kinomill.llm.common import table
from kinomill.session import scratch_path


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every document under a model of the documents labelled good and not toxic, and whether it stays."""
    trusted = table(spark, folder, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return quality.judge(table(spark, folder, "documents"), trusted)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of 20 words that occurred before."""
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies among all documents, through a new digest index."""
    index = exact_dedup.DigestIndex.open(spark, scratch_path(spark, "digests"))
    found = exact_dedup.deduplicate(table(spark, folder, "documents"), index)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), size=4, limit=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model, ["doc_id", langid.held_out(F.col("doc_id")).alias("held_out")])


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in pieces: the best segmentation, the next two, and whether decoding gives the text back."""
    encoded = pieces.encode(table(spark, folder, "documents"), ["doc_id"], n=3)
    return encoded.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed by source weight."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    cut = sharding.shard_documents(table(spark, folder, "documents"), 8)
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records, read back and stored by content."""
    root = scratch_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), f"{root}/archive", date="2024-01-01T00:00:00Z")
    store = warc.Store(spark, f"{root}/store")
    store.add(warc.read_archive(spark, f"{root}/archive"))
    return store.described().select(
        "page_id", "payload_bytes", F.col("sha1").alias("payload_digest"), "record_type", "refers_to"
    )


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings"), k=5, every=50)


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents against their manifest, where half of them lost their line breaks."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.replace("text", F.lit("\n"), F.lit(""))
    return merkle.verify(table(spark, folder, "documents"), scratch_path(spark, "merkle"), even, text)


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in byte-level pieces and back."""
    decoded = bpe.decode(bpe.encode(table(spark, folder, "documents"), ["doc_id"]), digest="ids_sha256")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    index = lexical.LexicalIndex(spark, scratch_path(spark, "lexical"))
    index.add(table(spark, folder, "documents"))
    return index.search(table(spark, folder, "benchmark"), k=50)


QUERIES = {q.__name__: q for q in (op1_quality, op2_substring_dedup, op3_exact_dedup, op4_simhash, op5_language_id, op6_pieces, op7_mixing, op8_warc, op9_sharding, op10_topk, op11_merkle, op12_bpe, op13_lexical)}

ORACLE = {
    "op3_exact_dedup": r"""
        with normal as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
            from documents
        )
        select doc_id,
               min(doc_id) over (partition by text_sha256) as keep_id,
               count(*) over (partition by text_sha256) as group_size,
               doc_id = min(doc_id) over (partition by text_sha256) as kept,
               text_sha256
        from normal
    """,
    "op7_mixing": r"""
        with sized as (
            select doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                   ('0x' || substr(md5(doc_id::varchar), 1, 12))::bigint as hash
            from documents
        ), sources as (
            select source, sum(size)::bigint as source_size,
                   row_number() over (order by source nulls last) as nth
            from sized group by source
        ), caps as (
            select *, (case nth % 3 when 1 then 5 when 2 then 2 else 1 end)::double as weight, source_size * 2.0::double as cap
            from sources
        ), levels as (
            select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over before, 0.0))
                      / (sum(weight) over () - coalesce(sum(weight) over before, 0.0)) as level
            from caps
            window before as (order by cap / weight, nth rows between unbounded preceding and 1 preceding)
        ), goals as (
            select source, source_size, least(cap, max(level) over () * weight) as target from levels
        ), passes as (
            select *, case when source_size > 0 then least(floor(target / source_size), 2) else 0 end as passes from goals
        ), running as (
            select s.*, source_size, target, passes, target - passes * source_size as budget,
                   sum(size) over (partition by s.source order by hash) as upto
            from sized s join passes p on s.source is not distinct from p.source
        ), edges as (
            select source, min(hash) as hash from running where upto > budget and budget > 0 group by source
        ), edge_sums as (
            select r.source, r.hash, max(upto) as upto, max(upto) - sum(size) as spent
            from running r join edges e on r.source is not distinct from e.source and r.hash = e.hash
            group by r.source, r.hash
        )
        select doc_id, size, source_size, target,
               (size * least(2, passes + case when r.hash < e.hash
                      or (r.hash = e.hash and e.upto - budget <= budget - spent) then 1 else 0 end))::bigint as taken
        from running r left join edge_sums e on r.source is not distinct from e.source
    """,
    "op8_warc": r"""
        with payloads as (
            select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
        ), numbered as (
            select *, min(page_id) over (partition by body) as head,
                   list_transform([1, 11, 21, 31], lambda i: ('0x' || substr(hex, i, 10))::bigint) as parts
            from payloads
        )
        select page_id, strlen(body)::bigint as payload_bytes,
               array_to_string(list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[(i // 8 + 1)::int] >> (35 - 5 * (i % 8))::int) & 31)::int + 1, 1)),
                   '') as payload_digest,
               case when page_id = head then 'response' else 'revisit' end as record_type,
               case when page_id <> head then head end as refers_to
        from numbered
    """,
    "op10_topk": r"""
        with ints as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(embedding) > 0
                  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, p.vec_id, list_dot_product(q.v::double[], p.v::double[])::bigint as score
            from ints q join ints p on p.vec_id <> q.vec_id
            where q.vec_id % 50 = 0
        )
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
        from scored
        qualify rank <= 5
    """,
    "op11_merkle": r"""
        with recursive hashed as (
            select doc_id, source, text, concat(
                       coalesce(concat(strlen(doc_id::varchar), ':', doc_id::varchar), '-'),
                       coalesce(concat(strlen(source), ':', source), '-'),
                       coalesce(concat(strlen(lang), ':', lang), '-'),
                       coalesce(concat(strlen(n_chars::varchar), ':', n_chars::varchar), '-')) as fields,
                   replace(text, chr(10), '') as cut,
                   list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(len(doc_id::varchar)), lambda i:
                           [1000 + ascii((doc_id::varchar)[i + 1]), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[]))),
                       lambda c, x: case when x > 0 then xor(c, x - 1000) else xor(c >> 1, 3988292384 * (c & 1)) end) & 1 as odd
            from documents
        ), leafs as (
            select doc_id, source, sha256(concat(fields, coalesce(concat(strlen(text), ':', text), '-'))) as leaf,
                   case when odd = 1 and text is not null then sha256(concat(fields, strlen(cut), ':', cut)) end as changed
            from hashed
        ), ranked as (
            select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank from leafs
        ), up as (
            select source, 0 as level, list(leaf order by rank) as nodes from ranked group by source
            union all
            select source, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i:
                       sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
            from up where len(nodes) > 1
        ), subroots as (
            select source, nodes[1] as subroot, row_number() over (order by source nulls first) - 1 as rank
            from up where len(nodes) = 1
        ), over_sources as (
            select 0 as level, list(subroot order by rank) as nodes from subroots
            union all
            select level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i:
                       sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
            from over_sources where len(nodes) > 1
        ), places as (
            select d.*, s.subroot, u.level, d.rank // (3 ** u.level)::bigint as place, u.nodes
            from ranked d join subroots s on d.source is not distinct from s.source
            join up u on d.source is not distinct from u.source and len(u.nodes) > 1
            union all
            select d.*, s.subroot, 1000 + u.level, s.rank // (3 ** u.level)::bigint, u.nodes
            from ranked d join subroots s on d.source is not distinct from s.source
            join over_sources u on len(u.nodes) > 1
        ), steps as (
            select doc_id, source, rank, list({
                       'l': array_to_string(nodes[place - place % 3 + 1 : place], ''),
                       'r': array_to_string(nodes[place + 2 : place - place % 3 + 3], '')} order by level) as steps
            from places group by doc_id, source, rank
        )
        select d.doc_id, leaf, subroot, o.nodes[1] as root,
               sha256(coalesce(array_to_string(list_transform(steps, lambda s: concat(s.l, s.r)), ''), '')) as proof_sha256,
               list_reduce(list_concat([{'l': coalesce(changed, leaf), 'r': ''}], coalesce(steps, [])),
                           lambda a, s: {'l': sha256(concat(s.l, a.l, s.r)), 'r': ''}).l as folded_root,
               folded_root = o.nodes[1] as verified
        from ranked d join over_sources o on len(o.nodes) = 1 join subroots s on d.source is not distinct from s.source
        left join steps t on d.source is not distinct from t.source and d.rank = t.rank
    """,
    "op13_lexical": r"""
        with cut as (
            select row_number() over () as nth, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents
        ), docs as (
            select nth, doc_id, terms, len(terms)::bigint as n from cut where len(terms) > 0
        ), totals as (
            select count(*)::bigint as big_n, sum(n)::bigint as big_l from docs
        ), postings as (
            select nth, doc_id, n, term, count(*)::bigint as tf
            from (select nth, doc_id, n, unnest(terms) as term from docs) group by all
        ), asked as (
            select distinct item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ), weights as (
            select term, floor(1000 * ln((2.0::double * big_n + 2) / (2.0::double * count(*) + 1)))::bigint as w
            from postings, totals group by term, big_n
        ), scored as (
            select item_id, nth, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::bigint as score
            from asked join postings using (term) join weights using (term), totals
            group by item_id, nth, doc_id
        )
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
        from scored where score > 0
        qualify rank <= 50
    """,
}


def queries() -> dict:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLE, **sql}
