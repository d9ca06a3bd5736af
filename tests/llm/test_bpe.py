"""BPE by distinct words against the tokenizers library on whole texts."""

import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from kinomill.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def made_rows():
    rnd = random.Random(5)
    signs = [*"aB19 '\n\t .<|>sé中͸\U0001f600", "<|endoftext|>", "'ll", " 's", "  ", "\x00", " ", " "]
    rows = [(i, "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60)))) for i in range(1500)]
    points = [c for c in range(1, 0x33480) if not 0xD800 <= c <= 0xDFFF]  # beyond: no letters or digits in any table
    for i in range(0, len(points), 3000):
        rows.append((10_000 + i, "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in points[i : i + 3000])))
    return [*rows, (-1, None), (-2, ""), (-3, "x" * 300_000), (-4, " " * 5000 + "a"), (None, "dup"), (None, "dup")]


@pytest.mark.parametrize("run_words", [20_000, 1_000_000])
def test_equals_the_library(spark, library, run_words):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 7, "c") for r in rows], "doc_id long, text string, ids int, `odd name` string").repartition(6)
    got = bpe.decode(bpe.encode(docs, ["doc_id", "odd name"], run_words=run_words)).collect()
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == want
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) and r["odd name"] == "c" for r in got)
    texts = dict(rows)
    assert all(r["decoded"] == (texts[r["doc_id"]] or "") for r in got)


def test_documents_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    encoded = bpe.encode(docs)
    encoded.collect()
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroupsInArrow") :]
    assert "Bucketed: true" in left and left.count("Exchange") <= 2 * 2  # shards and runs, never the documents


def test_foreign_ids(spark, library):
    lists = [[0, None, 60_000, 50_256, 128], None, [], [160, 161]]
    got = [r["decoded"] for r in bpe.decode(spark.createDataFrame([(x,) for x in lists], "ids array<int>").coalesce(1)).collect()]
    assert got == [library.decode([i for i in x or [] if i is not None], skip_special_tokens=False) for x in lists]


def test_one_python_process_decodes_and_digests(spark, small):
    """Texts and digests of a task come from one process; each further one holds a hundred megabytes of an executor."""
    plan = queries.op12_bpe(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("MapInArrow") == 1


def test_digests(spark):
    lists = [[1, 256], None, [], [3, None], [60_000]]
    got = bpe.decode(spark.createDataFrame([(x,) for x in lists], "ids array<int>").coalesce(1), digest="d").collect()
    assert [r["d"] for r in got] == [None if x is None or None in x else hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest() for x in lists]


def test_query(spark, small, library):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = queries.op12_bpe(spark, small).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode(rows[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()


def test_empty(spark):
    assert bpe.decode(bpe.encode(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_words_and_ids_are_sent_in_frames():
    """Numbers and bytes come back as they were, in far fewer bytes than lists of them take."""
    import numpy as np

    numbers, tail = np.arange(5_000, dtype=np.int32) % 3_000, b"word" * 2_000
    frame = bpe.squeezed(numbers, tail)
    back, rest = bpe.unsqueezed(frame, len(numbers))
    assert np.array_equal(back, numbers) and rest == tail and len(frame) < (4 * len(numbers) + len(tail)) / 4
    assert bpe.unsqueezed(bpe.squeezed(numbers[:0]), 0)[0].tolist() == []


def test_words_and_ids_are_squeezed_hard():
    """Frames of words and ids are most of the disk: smaller than the same bytes at zstd's level 5, and back unchanged."""
    import numpy as np
    import zstandard

    rng = np.random.default_rng(3)
    parts = ["inter", "pro", "ation", "ment", "ing", "er", "s", "al", "con", "duc", "tive", "str", "uct", "form", "ly", "re"]
    made = sorted({" " + "".join(rng.choice(parts, rng.integers(2, 6))) for _ in range(20_000)})
    lengths, tail = np.array([len(w) for w in made]), "".join(made).encode()
    frame = bpe.squeezed(lengths, tail)
    plain = np.ascontiguousarray(lengths.astype("<i4")).view(np.uint8).reshape(-1, 4).T.tobytes() + tail
    assert len(frame) < len(zstandard.ZstdCompressor(level=5).compress(plain))
    back, rest = bpe.unsqueezed(frame, len(made))
    assert back.tolist() == lengths.tolist() and rest == tail
