import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinomill.llm import quality


class Slow:
    """Interpolated modified Kneser-Ney over characters, from the definition."""

    def __init__(self, texts, order):
        self.order = order
        start = "\U0010ffff"
        raw = Counter()
        for t in texts:
            t = start * (order - 1) + t
            raw.update(t[i : i + order] for i in range(len(t) - order + 1))
        self.a = {order: raw}
        for k in range(order - 1, 0, -1):
            self.a[k] = Counter(g[1:] for g in self.a[k + 1])
        self.d = {}
        for k, grams in self.a.items():
            n = Counter(grams.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            self.d[k] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) if n[i] else i * y for i in (1, 2, 3)]
        self.by_context = {k: defaultdict(dict) for k in self.a}
        for k, grams in self.a.items():
            for g, n in grams.items():
                self.by_context[k][g[:-1]][g[-1]] = n
        self.alphabet = len(self.a[1])

    def p(self, gram, k=None):
        k = k or self.order
        gram = gram[len(gram) - k :]
        lower = self.p(gram, k - 1) if k > 1 else 1 / (self.alphabet + 1)
        seen = self.by_context[k].get(gram[:-1])
        if not seen:
            return lower
        cut = lambda n: self.d[k][min(n, 3) - 1]
        total = sum(seen.values())
        n = seen.get(gram[-1], 0)
        return (n and max(n - cut(n), 0)) / total + sum(map(cut, seen.values())) / total * lower

    def perplexity(self, text):
        t = "\U0010ffff" * (self.order - 1) + text
        logs = [math.log(self.p(t[i : i + self.order])) for i in range(len(text))]
        return math.exp(-sum(logs) / len(text))


@pytest.mark.parametrize("order", [3, 4])
def test_against_definition(spark, small, order, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_GRAMS", 2_000 if order == 3 else 100_000)
    monkeypatch.setattr(quality, "DENSE", 1 << 14)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.select("doc_id", "text", "lang").collect()}
    trusted = [d for d in rows if d % 3 == 0]
    models = {lang: Slow([rows[d]["text"] for d in trusted if rows[d]["lang"] == lang], order) for lang in {r["lang"] for r in rows.values()}}
    ids = spark.createDataFrame([(d,) for d in trusted], "doc_id long")
    got = {r["doc_id"]: r for r in quality.perplexities(docs, ids, order).collect()}
    assert len(got) == len(rows)
    for d in [*range(0, 40), 150]:
        assert got[d]["perplexity"] == pytest.approx(models[rows[d]["lang"]].perplexity(rows[d]["text"]), rel=1e-4)


def test_odd_rows(spark):
    rows = [(1, "abc abc", "en"), (1, "abc abc", "en"), (2, "abd", "en"), (3, None, "en"), (4, "", "en"), (5, "xyz", None), (6, "zz", "fr"), (None, "abc", "en"), (7, "a" * 200_000, "en"), (8, "\U0001f600\x00é", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, perplexity double")
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,), (99,), (7,)], "doc_id long")
    got = quality.judge(docs, ids, aside=1_000_003).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["perplexity"] is None and by_id[3]["keep"] and by_id[4]["keep"]
    assert by_id[5]["lang"] is None and by_id[5]["perplexity"] is None and by_id[5]["keep"]
    assert by_id[6]["perplexity"] is None and by_id[8]["perplexity"] > by_id[2]["perplexity"]
    assert all(r["keep"] for r in got if r["threshold"] is None)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.judge(docs, docs.select("doc_id")).collect() == []


def test_ranks_are_the_same_dense_or_sorted(monkeypatch):
    texts = ["hello world", "", "hello", "œuf 執 hello"]
    dense = quality.grams_of(texts, 4)
    monkeypatch.setattr(quality, "DENSE", 1)
    other = quality.grams_of(texts, 4)
    for (g, r, t), _ in ((dense, 0), (other, 0)):
        found = Counter((tuple(g[i]), int(x)) for i, x in zip(r, t))
        want = Counter()
        for n, text in enumerate(texts):
            codes = [quality.START] * 3 + [ord(c) for c in text]
            want.update((tuple(codes[i : i + 4]), n) for i in range(len(text)))
        assert found == want
    assert np.array_equal(dense[2], other[2])
