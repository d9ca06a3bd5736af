import math

import numpy as np
import pytest

from kinomill.llm import topk


def brute_force(rows, k, every):
    good = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, (i, q) in enumerate(good):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, p)), j) for j, p in good if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("bucket", [32_768, 64])
def test_against_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(1_500):
        v = centres[i % 6] * rng.choice([0.1, 1.0, 3.0]) + rng.normal(size=12) * rng.choice([0.01, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v]))
    same = rows[10][1]
    rows += [(2_000 + i, same) for i in range(60)]
    rows += [(3_000, None), (3_050, []), (3_100, [1.0, None]), (3_150, [float("nan")] * 12), (3_200, [float("inf")] * 12), (None, same)]
    rows += [(3_250, [0.0] * 12), (3_300, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, score int").repartition(6)
    assert got(topk.top_k(df)) == brute_force(rows, 5, 50)


def test_few_rows_and_large_numbers(spark):
    schema = "vec_id long, embedding array<float>"
    assert got(topk.top_k(spark.createDataFrame([], schema))) == []
    assert got(topk.top_k(spark.createDataFrame([(0, [1.0])], schema))) == []
    rows = [(0, [1e6, 3.0]), (1, [1e6, -1.0]), (2, [-1e6, 7.0]), (50, [2.0**20, 1.0])]
    assert got(topk.top_k(spark.createDataFrame(rows, schema))) == brute_force(rows, 5, 50)
    huge = [(0, [1e30]), (1, [1e30])]
    assert got(topk.top_k(spark.createDataFrame(huge, schema))) == [(0, 1, 1, (1 << 63) - 1)]


def test_pruning_keeps_what_reaches_the_floor():
    rng = np.random.default_rng(1)
    p = np.floor(rng.normal(size=(400, 8)) * 100)
    p = p[np.argsort(-np.sqrt((p * p).sum(1)))]
    q = np.floor(p[:40] * 1.0)
    scores = q @ p.T
    floor = np.sort(scores, axis=1)[:, -5].astype(float)
    for query, ids, best in topk.search_cell(np.arange(1000, 1040), q, floor, np.arange(400), p, 5):
        row = scores[query - 1000]
        assert sorted(best, reverse=True) == sorted(row, reverse=True)[:5]


def test_components_beyond_scaling_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1e307, 0.0]), (3, [1e300, 0.0]), (4, [-1.7e308, 1.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=50).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 3), (2, 1)]
    assert found[0]["score"] <= topk.LONG[1]
