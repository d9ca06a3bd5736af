"""What the physical plans must and must not contain."""

import pytest

from kinomill.catalog import analysis, cleaning, graph, quality, rules, storage

NATIVE = {
    **{k: cleaning.QUERIES[k] for k in ("fold_accents", "format_values", "title_year", "join_left")},
    **{k: graph.QUERIES[k] for k in ("triples_person", "triples_name", "triples_merge", "entail_types")},
    **{k: quality.QUERIES[k] for k in ("ts_outliers", "impute_midpoint", "profile_columns")},
    **{k: rules.QUERIES[k] for k in ("trust_zone", "constraint_arrays")},
    **{k: analysis.QUERIES[k] for k in ("genre_by_decade", "collaborations", "top_rated", "box_stats")},
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(NATIVE))
def test_no_python_and_no_cross_join(spark, small, key):
    text = plan(NATIVE[key](spark, small))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(analysis.genre_by_decade(spark, small))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in text
    text = plan(rules.constraint_domain(spark, small))
    assert "In(l_linenumber, [1,2])" in text and "GreaterThanOrEqual(l_quantity,0.0)" in text


def test_top_k_needs_no_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(analysis.top_rated(spark, small))


def test_windows_are_partitioned(spark, small):
    assert "SinglePartition" not in plan(quality.ts_outliers(spark, small))
    assert "SinglePartition" not in plan(quality.impute_linear(spark, small))


def test_ratings_are_summed_before_the_join(spark, small):
    text = plan(analysis.genre_rating(spark, small))
    assert text.index("sum(score_sum") < text.index("Join") < text.rindex("sum(score")


def test_right_sides_are_merged_before_they_are_shuffled(spark, small):
    """A key that fills the right side of a semi or anti join is one row per task."""
    for df in (storage.incremental_new_keys(spark, small), storage.referenced_people(spark, small), cleaning.join_semi(spark, small)):
        text = plan(df)
        right = text[text.index("Join") :]
        right = right[right.index("Exchange", right.index("Exchange") + 1) :]
        assert "HashAggregate" in right
