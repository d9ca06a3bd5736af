"""The stages against plain Python, each on what its predecessor left; operators have their own tests."""

import re
from collections import Counter

import __spark_entry__ as entry_module
import corpus_pipeline
from kinomill.llm import langid, mixing, pieces, queries
from test_near_copies import slow_components


def test_registered():
    keys = set(entry_module.queries())
    assert set(queries.queries()) <= keys and "pipeline" in keys
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(entry_module.oracle_sql())


def test_stages(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(900, None, "en", "s", 0), (901, "!! 12", "en", "s", 5), (902, docs.first()["text"], None, None, 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    now, seen = docs, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, small).write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(now)
        if i < 4:
            assert now.columns == docs.columns
    languages, exact, near, mixed, encoded = (s.collect() for s in seen)

    model = langid.train(docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    stay = {r["doc_id"] for r in docs.collect() if model.predict(r["text"])[0] != "und"}
    assert {r["doc_id"] for r in languages} == stay and not {900, 901} & stay
    assert all(r["lang"] for r in languages)

    first: dict = {}
    for r in sorted(languages, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert Counter(r["doc_id"] for r in exact) == Counter(first.values())

    groups: dict = {}
    for r, root in zip(exact, slow_components([r["text"] for r in exact])):
        groups.setdefault(root, []).append(r["doc_id"])
    assert Counter(r["doc_id"] for r in near) == Counter(min(ids) for ids in groups.values())
    assert {1} <= {r["doc_id"] for r in near} and 177 not in {r["doc_id"] for r in near}  # similarity 0.83, nine bits apart

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(seen[2]).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed) == Counter(copies)

    assert Counter(r["doc_id"] for r in encoded) == Counter(copies)
    assert all(r["decoded_equal"] for r in encoded)
    texts = {r["doc_id"]: r["text"] for r in near}
    vocabulary = pieces.load()
    encoder = pieces.Encoder(n=1)
    for r in encoded[:20]:
        ids = encoder.encode([texts[r["doc_id"]]])[0]
        assert ids.tolist() == r["ids"] and max(ids) < len(vocabulary.pieces)


def test_rows_without_ids(spark):
    """Null ids and ids that repeat in another source are decided by text and source, not by id alone."""
    rows = [(None, "one text of quite a few words that stays", "a"), (None, "one text of quite a few words that stays", "a")]
    rows += [(None, "another text with no word in common here", "a"), (5, "five words or six of them", "a"), (5, "something else under this very number", "b")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert Counter(r["text"] for r in kept) == Counter({t for _, t, _ in rows})
    mixed = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (None, "a", 0)], "doc_id long, source string, copies long")
    taken = Counter((r["doc_id"], r["source"]) for r in mixing.repeat(docs, mixed).collect())
    assert taken == Counter({(5, "a"): 1, (5, "b"): 2})


def test_no_language_known(spark):
    docs = spark.createDataFrame([(1, "wörter"), (2, "12 !"), (3, None)], "doc_id long, text string").selectExpr(
        "doc_id", "text", "cast(null as string) lang", "'s' source", "1L n_chars"
    )
    assert [r["doc_id"] for r in corpus_pipeline.keep_language(spark, docs, "").collect()] == [1]


def test_empty(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_queries_equal_their_sql(spark, small):
    from check_oracle import compare, connect

    duck = connect(small)
    for key, sql in queries.oracle_sql().items():
        assert compare(queries.queries()[key](spark, small), duck, sql) is None, key
