"""Exact quantiles by bracket and count, and what stands on them."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kinomill.operators import impute, outliers, quantiles
from kinomill.operators.ordered import exact_quantiles
from kinomill.plans import trusted


def by_hand(values, p, interpolate):
    x = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    if not interpolate:
        return x[max(math.ceil(len(x) * p), 1) - 1]
    spot = (len(x) - 1) * p
    low, high = x[math.floor(spot)], x[math.ceil(spot)]
    return low + (high - low) * (spot - math.floor(spot))


def made():
    rng = random.Random(2)
    rows = [("ties", float(rng.choice([1, 2, 2, 2, 3]))) for _ in range(3000)]
    rows += [("skew", rng.paretovariate(0.4)) for _ in range(5000)] + [("one", 7.0), (None, 5.0), (None, 6.0), ("gone", None)]
    rows += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(2000)]
    rows += [("nan", float("nan")), ("nan", 1.0), ("nan", 2.0), ("inf", float("inf")), ("inf", float("-inf")), ("inf", 0.0)]
    return rows


@pytest.mark.parametrize("interpolate", [False, True])
@pytest.mark.parametrize("most,size", [(200_000, 800), (20, 8)])
def test_against_sorting(spark, interpolate, most, size):
    """With a tiny sketch ranks are missed and brackets stay wide: both are mended until they are right."""
    rows = made()
    if interpolate:
        rows = [r for r in rows if r[0] not in ("nan", "inf", "wide")]
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = quantiles.exact_quantiles(df, "v", probs, ["g"], interpolate, most=most, sketch_size=size).collect()
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert {r["g"] for r in got} == set(groups)
    for r in got:
        for i, p in enumerate(probs):
            want = by_hand(groups[r["g"]], p, interpolate)
            assert r[f"q{i}"] == want or (math.isnan(want) and math.isnan(r[f"q{i}"])) or r[f"q{i}"] == pytest.approx(want, rel=1e-12)


def test_types_keep_their_values(spark):
    big = [2**53 + i for i in range(7)]
    df = spark.createDataFrame([(b, Decimal(b) / 10, i) for i, b in enumerate(big)], "b bigint, d decimal(38,1), s int")
    for column, values in (("b", big), ("d", [Decimal(b) / 10 for b in big]), ("s", list(range(7)))):
        row = exact_quantiles(df, column, [0.3, 0.5, 0.9]).first()
        assert list(row) == [by_hand(values, p, False) for p in (0.3, 0.5, 0.9)]
    filled = impute.impute_numeric(df.union(spark.createDataFrame([(None, None, None)], df.schema)))
    assert filled.where("s = 3").count() == 2 and {r["b"] for r in filled.where("s = 3").collect()} == {big[3]}
    assert dict(filled.dtypes) == dict(df.dtypes)


def test_no_values(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert quantiles.exact_quantiles(empty, "v", [0.5]).collect() == [(None,)]
    assert quantiles.exact_quantiles(empty, "v", [0.5], ["g"]).collect() == []


def test_nothing_is_range_partitioned_or_written_whole(spark, monkeypatch):
    """What is written is as large as the brackets, not as the table."""
    df = spark.range(200_000).select((F.xxhash64("id") / 1e9).alias("v"))
    written = []
    original = quantiles.cut_lineage
    monkeypatch.setattr(quantiles, "cut_lineage", lambda x: written.append(original(x)) or written[-1])
    kept = outliers.trim_outliers(df, "v")
    assert 0.899 < kept.count() / 200_000 < 0.901
    assert sum(x.count() for x in written) < 0.1 * 200_000
    assert "rangepartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_trust_hands_approximate_to_the_band(spark, monkeypatch):
    seen = []
    original = trusted.split_outliers
    monkeypatch.setattr(trusted, "split_outliers", lambda *a, **k: seen.append(k["approximate"]) or original(*a, **k))
    from kinomill.plans import domain

    people = domain.crew_data(spark, "/root/testdata/sf0.001")
    for approximate in (False, True):
        trusted.trust(people, "crew_data", approximate=approximate)
    assert seen == [False, True]


def test_few_groups_are_broadcast(spark, monkeypatch):
    """The rows of three groups are not sorted in three tasks to meet their brackets."""
    plans, cut = [], quantiles.cut_lineage

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(quantiles, "cut_lineage", spy)
    df = spark.createDataFrame(made()[:3000], "g string, v double")
    exact_quantiles(df, "v", [0.5], ["g"]).collect()
    assert any("BroadcastHashJoin" in p for p in plans) and not any("SortMergeJoin" in p for p in plans)
