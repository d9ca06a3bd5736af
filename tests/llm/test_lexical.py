"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from kinomill.llm import lexical
from kinomill.session import scratch_path

FOLD = str.maketrans(lexical._UPPER, lexical._LOWER)


def terms(text):
    return re.findall(lexical.TERM, (text or "").translate(FOLD))


def score_all(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    for item, wanted in asked.items():
        found = []
        for i, c, size in counted:
            m = 50 + (50 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def made():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ß9", "Ab", "aB"]

    def text(n):
        return " ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))

    docs = [(rnd.choice([None, *range(500)]), rnd.choice([None, "", "...", text(rnd.randint(1, 60)), text(30)])) for _ in range(700)]
    docs += [(1000 + i, "w1 w2 w3 copy") for i in range(120)] + [(5000, "w7 " * 50_000)]
    items = [(i, text(rnd.randint(1, 20))) for i in range(25)]
    return docs, items + [(3, "w50"), (None, "w1 w9"), (77, None), (78, "zzz"), (79, "copy w1"), (80, "")]


@pytest.mark.parametrize("size,splits", [(400, 24), (100_000, 24), (3_000, 1)])
def test_against_scoring_all(spark, size, splits, monkeypatch):
    monkeypatch.setattr(lexical, "PROBE_SPLITS", splits)
    docs, items = made()
    index = lexical.LexicalIndex(spark, scratch_path(spark, "lexical"))
    index.add(spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, n int").repartition(5), size)
    found = index.search(spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, score int"), 10)
    assert sorted(map(tuple, found.collect()), key=repr) == score_all(docs, items, 10)


def test_added_segments_and_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 4)
    docs, items = made()
    index = lexical.LexicalIndex(spark, scratch_path(spark, "lexical"))
    for at in (0, 1, 2):
        index.add(spark.createDataFrame(docs[at::3], "doc_id long, text string").repartition(2), 900)
    found = index.search(spark.createDataFrame(items, "item_id long, text string"), 50)
    assert sorted(map(tuple, found.collect()), key=repr) == score_all(docs, items, 50)


def test_few_documents_are_scored(spark):
    """Intervals that cannot reach the k-th best score are left without looking at their documents."""
    import numpy as np

    rng = np.random.default_rng(1)
    docs = [np.sort(rng.choice(20_000, n, replace=False)).astype(np.int32) for n in (40, 300, 15_000)]
    lists = lexical._Lists(docs, [np.ones(len(d), np.int32) for d in docs], np.array([7000, 4000, 10]), np.full(20_000, 100))
    scored = []
    original = lists.largest
    lists.largest = lambda low, high: scored.append(len(low)) or original(low, high)
    found, scores = lexical.search_segment(lists, np.arange(3), 20_000, 5, 1, None)
    want = np.zeros(20_000, np.int64)
    for i, d in enumerate(docs):
        want[d] += lists.impact[lists.ends[i] : lists.ends[i + 1]]
    order = np.lexsort((np.arange(20_000), -want))[:5]
    assert found.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    assert sum(scored) < 2_000


def test_empty(spark):
    index = lexical.LexicalIndex(spark, scratch_path(spark, "lexical"))
    index.add(spark.createDataFrame([], "doc_id long, text string"))
    assert index.search(spark.createDataFrame([(1, "a")], "item_id long, text string"), 3).collect() == []
