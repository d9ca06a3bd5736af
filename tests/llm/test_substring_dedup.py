import random
import re

import pytest

from kinomill.llm import substring_dedup


def brute_force(rows, window):
    """Rows (doc_id, text): words, removed words, kept text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [float("inf") if d is None else d for d, _ in rows]
    first = {}
    for d, w in zip(ids, words):
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, (d, s)), (d, s))
    out = []
    for (doc_id, _), d, w in zip(rows, ids, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if (d, s) > first[tuple(w[s : s + window])]:
                gone.update(range(s, s + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr)


@pytest.mark.parametrize("group_leaves", [substring_dedup.GROUP_LEAVES, 3])
def test_documents(spark, small, group_leaves):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(substring_dedup.remove_repeats(docs, group_leaves=group_leaves)) == brute_force(rows, 20)


@pytest.mark.parametrize("group_leaves", [10_000, 4])
def test_random_texts_with_short_windows(spark, group_leaves):
    rng = random.Random(5)
    shared = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(4, 30))] for _ in range(12)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(shared)[: rng.randrange(3, 30)] if rng.random() < 0.7 else [rng.choice("xyz")] * rng.randrange(1, 20)
        rows.append((rng.choice([i, i, i, None]), rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(7000, None), (7001, ""), (7002, "a b c")] * 2
    rows += [rows[3]]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string").repartition(5)
    assert got(substring_dedup.remove_repeats(docs, window=7, prefix=3, group_leaves=group_leaves)) == brute_force(rows, 7)


def test_empty(spark):
    assert got(substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))) == []
