"""Cut groups give the same results as whole ones, whatever the share of the largest key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinomill.operators import impute, ordered
from kinomill.operators.outliers import trim_outliers, ts_outliers
from kinomill.operators.summaries import box_stats

CUT = {"pieces": 8}
WHOLE = {"pieces": 1}
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark, small):
    """A third of the events belong to one key, which is NULL."""
    df = spark.read.parquet(f"{small}/events.parquet").select("event_id", "ts", "user_id", "value")
    hot = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    return df.withColumn("user_id", hot).cache()


def test_pieces_cut_the_large_key_and_are_balanced(events):
    placed = ordered.range_pieces(events, ["user_id"], ORDER, 8)
    sizes = [r["count"] for r in placed.groupBy(ordered.PIECE).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 3 * events.count() / 8
    several = placed.groupBy("user_id").agg(F.count_distinct(ordered.PIECE).alias("n")).where("n > 1").collect()
    assert len(several) < 8 and max(r["n"] for r in several if r["user_id"] is None) > 1


def test_one_key_of_one_order_value(spark, rows):
    """Nine tenths of the rows tie on key and order; they are still cut, and sums are right."""
    df = spark.range(2_000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), F.lit(1).alias("o"), F.lit(1).alias("v")
    )
    placed = ordered.range_pieces(df, ["k"], ["o"], 8)
    assert max(r["count"] for r in placed.groupBy(ordered.PIECE).count().collect()) < 3 * 2_000 / 8
    got = ordered.running_total(df, ["k"], ["o"], "v", **CUT)
    hot = sorted(r["upto"] for r in got.where("k = -1").collect())
    assert hot == list(range(1, 1_801))
    assert {r["total"] for r in got.where("k = -1").collect()} == {1_800}
    padded, group = ordered.with_halo(df, ["k"], ["o"], 3, **CUT)
    frame = Window.partitionBy(*group).orderBy("o", ordered.TIE).rowsBetween(-3, 0)
    full = padded.withColumn("n", F.count("v").over(frame)).where("not __halo and k = -1")
    assert sorted(r["n"] for r in full.collect())[:4] == [1, 2, 3, 4]


def test_building_a_frame_writes_once(spark, events):
    """Nothing but the partitioning of the rows runs before the first action."""
    tracker = spark.sparkContext.statusTracker()
    counts = events.groupBy("user_id", "value").agg(F.count(F.lit(1)).alias("n"))
    spark.sparkContext.setJobGroup("write", "write")
    ordered.range_pieces(counts, ["user_id"], ["value"], 8)
    written = len(tracker.getJobIdsForGroup("write"))
    spark.sparkContext.setJobGroup("build", "build")
    ordered.running_total(counts, ["user_id"], ["value"], "n", **CUT)
    assert len(tracker.getJobIdsForGroup("build")) <= written
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("by", [["user_id"], []])
def test_running_total(events, rows, by):
    def result(**limits):
        df = ordered.running_total(events, by, ORDER, "value", **limits)
        return rows(df, "event_id", F.round("upto", 6), F.round("total", 6))

    assert result(**WHOLE) == result(**CUT) == result()


@pytest.mark.parametrize("by", [["user_id"], []])
def test_halo(events, rows, by):
    def result(**limits):
        df, group = ordered.with_halo(events, by, ORDER, 4, **limits)
        frame = Window.partitionBy(*group).orderBy(*ORDER).rowsBetween(-4, 0)
        return rows(df.withColumn("s", F.round(F.sum("value").over(frame), 6)).where("not __halo"), "event_id", "s")

    assert result(**WHOLE) == result(**CUT) == result()


@pytest.mark.parametrize("mode", ["midpoint", "linear"])
@pytest.mark.parametrize("sparse", [2, 40])
def test_imputation(events, rows, mode, sparse):
    """With few values a gap spans several pieces."""
    gappy = events.withColumn("value", F.when(F.col("event_id") % sparse == 0, F.col("value")))

    def result(**limits):
        return rows(impute.impute_midpoint(gappy, ORDER, ["user_id"], ["value"], mode=mode, **limits))

    assert result(**WHOLE) == result(**CUT) == result()


def test_series_outliers(events, rows):
    def result(**limits):
        return rows(ts_outliers(events, "value", ORDER, ["user_id"], k=1.0, **limits))

    assert result(**WHOLE) == result(**CUT) == result()


@pytest.mark.parametrize("interpolate", [True, False])
def test_quantiles_of_uneven_groups(events, interpolate):
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    names = [f"q{i}" for i in range(5)]
    got = ordered.exact_quantiles(events, "value", probs, ["user_id"], interpolate=interpolate, **CUT)
    if interpolate:
        wanted = events.groupBy("user_id").agg(F.percentile("value", probs).alias("p"))
    else:
        disc = [F.expr(f"percentile_disc({p}) within group (order by value)") for p in probs]
        wanted = events.groupBy("user_id").agg(F.array(*disc).alias("p"))
    by_key = {r["user_id"]: [round(x, 9) for x in r["p"]] for r in wanted.collect()}
    assert by_key == {r["user_id"]: [round(r[n], 9) for n in names] for r in got.collect()}


def test_box_and_band(events, rows):
    keyed = events.withColumn("user_id", F.coalesce("user_id", F.lit(-1)))
    assert rows(box_stats(keyed, "user_id", "value")) == rows(box_stats(keyed, "user_id", "value", **CUT))
    assert rows(trim_outliers(events, "value")) == rows(trim_outliers(events, "value", **CUT))


def test_empty_input(events):
    nothing = events.where("false")
    assert ordered.exact_quantiles(nothing, "value", [0.5]).collect() == [(None,)]
    assert trim_outliers(nothing, "value").count() == 0
    assert ts_outliers(nothing, "value", ORDER, ["user_id"]).count() == 0
