"""Split, index, ranks and training against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinomill.operators import embeddings as E
from kinomill.operators import ranking as R
from kinomill.operators import training


@pytest.fixture(scope="module")
def triples(spark):
    rows = [(f"e{i % 7}", f"r{i % 3}", f"e{(i * 5) % 23}") for i in range(150)]
    return spark.createDataFrame(sorted(set(rows)), "s string, p string, o string")


def test_split_covers_every_term(triples):
    parts = E.split_triples(triples)
    train = parts.where("part = 'train'").collect()
    assert parts.count() == triples.count() and 0 < parts.where("part = 'test'").count()
    entities = {x for r in triples.collect() for x in (r.s, r.o)}
    assert {x for r in train for x in (r.s, r.o)} == entities
    assert {r.p for r in train} == {"r0", "r1", "r2"}
    assert sorted(map(tuple, E.split_triples(triples).collect())) == sorted(map(tuple, parts.collect()))


@pytest.mark.parametrize("limits", [{}, {"pieces": 6}])
def test_ids_are_dense_and_ordered(triples, limits):
    got = sorted((r.id, r.entity) for r in E.index_entities(triples, **limits).collect())
    assert [i for i, _ in got] == list(range(len(got)))
    assert [e for _, e in got] == sorted(e for _, e in got)


def _model(spark, copies=False):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(40, 6))
    if copies:
        vectors[10:20] = vectors[9]
    w = rng.normal(size=(2, 6))
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    d = rng.normal(size=(2, 6))
    entities = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    relations = spark.createDataFrame([(i, w[i].tolist(), d[i].tolist()) for i in range(2)], "id int, w array<double>, d array<double>")
    return vectors, w, d, entities, relations


def _brute(vectors, w, d, test, known):
    def score(h, r, t):
        u = vectors[h] - vectors[t]
        v = u - (w[r] @ u) * w[r] + d[r]
        return round(-float(v @ v), 9)

    out = {}
    for h, r, t in test:
        for side in ("head", "tail"):
            own, better, ties, n = score(h, r, t), 0, 0, 1
            for c in range(len(vectors)):
                cand = (c, r, t) if side == "head" else (h, r, c)
                if cand in known or cand == (h, r, t):
                    continue
                s, n = score(*cand), n + 1
                better, ties = better + (s > own), ties + (s == own)
            out[h, r, t, side] = (1 + better, 1 + better + ties, 1 + better + ties / 2, n)
    return out


@pytest.mark.parametrize("copies", [False, True])
@pytest.mark.parametrize("limits", [{}, {"pieces": 4}])
def test_ranks_in_blocks(spark, copies, limits):
    """Head 0 has most of the triples; blocks are far smaller than the data."""
    vectors, w, d, entities, relations = _model(spark, copies)
    known = {(0, 0, t) for t in range(1, 30)} | {(i, 1, (i * 7 + 1) % 40) for i in range(20)}
    test = [x for x in sorted(known) if sum(x) % 3]
    frame = lambda rows: spark.createDataFrame(sorted(rows), "h_id bigint, r_id int, t_id bigint")
    ranks = R.rank_triples(frame(test), entities, relations, frame(known), query_block=9, entity_block=11, **limits)
    got = {(r.h_id, r.r_id, r.t_id, r.side): (r.optimistic, r.pessimistic, r.realistic, r.candidates) for r in ranks.collect()}
    assert got == _brute(vectors, w, d, test, known)


def test_closed_forms(spark):
    df = spark.createDataFrame([(n, a) for n in (1, 2, 19, 20, 21, 1000) for a in (0.001, 0.5, 1.0, -2.0)], "n int, a double")
    for r in df.select("n", "a", R.mean_power(F.col("n"), F.col("a")).alias("m"), R.mean_inverse(F.col("n")).alias("i")).collect():
        assert r.m == pytest.approx(sum(j**r.a for j in range(1, r.n + 1)) / r.n, rel=1e-9)
        assert r.i == pytest.approx(sum(1 / j for j in range(1, r.n + 1)) / r.n, rel=1e-9)


def test_metric_values(spark):
    values = [1, 2, 2, 7, 40]
    ranks = spark.createDataFrame([(v, v, float(v), 50 + i, "tail") for i, v in enumerate(values)], "optimistic int, pessimistic int, realistic double, candidates int, side string")
    got = {(r.side, r.kind): r for r in R.rank_metrics(ranks).collect()}
    assert len(got) == 6
    r = got["both", "realistic"]
    x, n = np.array(values, float), np.arange(50, 55)
    assert r["arithmetic_mean_rank"] == pytest.approx(x.mean())
    assert r["geometric_mean_rank"] == pytest.approx(math.exp(np.log(x).mean()))
    assert r["harmonic_mean_rank"] == pytest.approx(1 / (1 / x).mean())
    assert (r["median_rank"], r["hits_at_1"], r["hits_at_3"]) == (2, 0.2, 0.6)
    assert r["standard_deviation"] == pytest.approx(x.std()) and r["variance"] == pytest.approx(x.var())
    assert r["median_absolute_deviation"] == pytest.approx(1.482602218505602 * np.median(abs(x - 2)))
    expected = ((n + 1) / 2).mean()
    assert r["adjusted_arithmetic_mean_rank_index"] == pytest.approx(1 - (x.mean() - 1) / (expected - 1))
    p = np.minimum(10 / n, 1)
    assert r["adjusted_hits_at_k"] == pytest.approx((0.8 - p.mean()) / (1 - p.mean()))
    assert r["z_hits_at_k"] == pytest.approx((0.8 - p.mean()) / math.sqrt((p * (1 - p)).sum() / 25))
    inverse = [1 / np.arange(1, k + 1) for k in n]
    e, v = np.array([i.mean() for i in inverse]), sum(i.var() for i in inverse)
    assert r["z_inverse_harmonic_mean_rank"] == pytest.approx(((1 / x).mean() - e.mean()) / math.sqrt(v / 25))
    geo = np.prod([(np.arange(1, k + 1) ** 0.2).mean() for k in n])
    geo2 = np.prod([(np.arange(1, k + 1) ** 0.4).mean() for k in n])
    gmr = r["geometric_mean_rank"]
    assert r["adjusted_geometric_mean_rank_index"] == pytest.approx(1 - (gmr - 1) / (geo - 1))
    assert r["z_geometric_mean_rank"] == pytest.approx((geo - gmr) / math.sqrt(geo2 - geo**2))


def test_training_lowers_the_loss(triples):
    model = training.train_transh(triples, dim=8, epochs=4, learning_rate=0.1)
    assert model.losses[-1] < model.losses[0]
    assert model.entities.count() == 23
    norms = [np.linalg.norm(r.w) for r in model.relations.collect()]
    assert norms == pytest.approx([1.0] * 3)
    assert max(np.linalg.norm(r.vector) for r in model.entities.collect()) <= 1 + 1e-9


def test_clusters(spark):
    rows = [(i, [float(i // 10) * 10 + i * 0.01, 0.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    got = E.cluster_entities(df, k=5).collect()
    assert len(got) == 50 and {r.cluster for r in got} == set(range(5))


def test_balls_count_without_scoring(spark):
    """Clustered entities: most are counted by their balls, and the counts are those of scoring every entity."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 6)) * 10
    vectors = [centres[i % 20] + rng.normal(size=6) * 0.05 for i in range(2_000)]
    entities = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vector array<double>")
    w = rng.normal(size=6)
    w, d = w / np.linalg.norm(w), rng.normal(size=6)
    relations = spark.createDataFrame([(0, [float(x) for x in w], [float(x) for x in d])], "id int, w array<double>, d array<double>")
    edges = [(i, 0, (i * 37 + 20) % 2_000) for i in range(0, 2_000, 40)]
    triples = spark.createDataFrame(edges, "h_id long, r_id int, t_id long")
    e = np.array(vectors)
    plane = e - np.outer(e @ w, w)
    for blocks in ((16, 300), (10_000, 100_000)):
        counted, size = R.counted_candidates(triples, entities, relations, *blocks)
        rows = {(r.h_id, r.t_id, r.side): r for r in counted.collect()}
        assert size == 2_000 and len(rows) == 2 * len(edges)
        for h, _, t in edges:
            for side in ("head", "tail"):
                gaps = plane[h] + d - (d @ w) * 0 * w - plane if side == "tail" else plane + d - plane[t]
                scores = R._comparable(-(gaps * gaps).sum(axis=1))
                own, target = scores[t if side == "tail" else h], t if side == "tail" else h
                others = np.delete(scores, target)
                assert (rows[h, t, side].better, rows[h, t, side].ties) == ((others > own).sum(), (others == own).sum())
        assert sum(r.scored for r in rows.values()) < 0.25 * len(rows) * 2_000
