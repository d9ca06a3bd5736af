from collections import Counter

import pytest
from kinomill.llm import components as K


@pytest.mark.parametrize("few", [K.FEW, 0])
def test_components_of_few_and_of_many_edges(spark, monkeypatch, few):
    monkeypatch.setattr(K, "FEW", few)
    pairs = [(i, i + 1) for i in range(20)] + [(40, 30), (30, 35), (35, 40), (50, 50), (61, -60), (70, 61)]
    got = {(r["node"], r["root"]) for r in K.components(spark.createDataFrame(pairs, "u bigint, v bigint").repartition(3)).collect()}
    want = {(i, 0) for i in range(21)} | {(30, 30), (35, 30), (40, 30), (-60, -60), (61, -60), (70, -60)}
    assert got == want


def test_rows_are_nodes_once(spark):
    rows = K.components(spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "u bigint, v bigint")).collect()
    assert max(Counter(r["node"] for r in rows).values()) == 1


def test_a_round_over_one_partition_has_no_shuffle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3)], "u bigint, v bigint").coalesce(1)
    plan = K._small(K._large(edges, True).distinct(), True).distinct()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
