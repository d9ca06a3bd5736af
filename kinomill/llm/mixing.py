"""Mix sources to target weights with hash-threshold histograms, in DataFrame operations only.

Each document gets a 48-bit hash of its id. A source's budget is reached by
taking every document whose hash is below a threshold, so nothing is sorted:
words are summed by source and hash bucket, the bucket in which the running sum
passes the budget is found, and only that bucket is summed again, finer.
Whole passes over a source come first; the threshold picks the rest.
Thresholds are nested: a larger budget takes a superset.

Defined results: null text has size 0, a null source is a source of its own and
last in the order, ids that repeat share their hash and are taken together, a
source without words has target 0, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomill.llm.common import word_count
from kinomill.session import cut_lineage

LEVELS = 6
BITS = 8  # per level; LEVELS * BITS bits of the hash are used
BROADCAST_SOURCES = 50_000  # a table of one short row per source; above this Spark chooses the join


def document_hash(doc_id: Column) -> Column:
    """48 bits of the MD5 of the id as text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, LEVELS * BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Weights go round in the order of the sources. Targets are the water level
    times the weight, stopped at ``most`` times the size: the level at which the
    stopped ones are served is the highest of those got by filling in order of
    size by weight. The two windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") - 1) % len(weights) + 1)
    named = (
        sources.withColumn("at", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(filled), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = named.withColumn("level", (total - before) / left)
    best = F.max("level").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return level.withColumn("target", F.least("cap", best * F.col("weight"))).select(
        "source", "source_size", "weight", "target"
    )


def _on_source(left: DataFrame, right: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "r_source")
    right = F.broadcast(right) if few else right
    return left.join(right, F.col("source").eqNullSafe(F.col("r_source")), how).drop("r_source")


def thresholds(sized: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """Hash threshold per source: documents with a smaller hash fill ``budget`` words.

    The document (or documents of one hash) at the threshold comes in too if
    the sum is then nearer to the budget: column ``with_edge``.
    """
    # prefix: hash bits fixed so far; spent: words below the bucket with that prefix.
    edge = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("spent"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = _on_source(sized, edge, few).where(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", "budget", "spent", F.shiftright("hash", shift).alias("prefix")).agg(
            F.sum("size").alias("words"),
        )
        running = Window.partitionBy("source").orderBy("prefix")
        upto = F.col("spent") + F.sum("words").over(running)
        # The first bucket with which the sum passes the budget; whole passes leave less than the source holds.
        passed = sums.withColumn("upto", upto).where("upto > budget")
        edge = passed.groupBy("source").agg(
            F.first("budget").alias("budget"),
            F.min_by("prefix", "prefix").alias("prefix"),
            F.min_by(F.col("upto") - F.col("words"), "prefix").alias("spent"),
            F.min_by("words", "prefix").alias("words"),
        )
    nearer = F.col("spent") + F.col("words") - F.col("budget") <= F.col("budget") - F.col("spent")
    return edge.select("source", F.col("prefix").alias("threshold"), nearer.alias("with_edge"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies and taken.

    ``copies`` times the document goes into the mix, at most ``most`` times.
    """
    sized = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            document_hash(F.col("doc_id")).alias("hash"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = cut_lineage(targets(sources, weights, share, most))
    few = goals.count() <= BROADCAST_SOURCES
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("passes", F.least(passes, F.lit(most)).cast("long"))
    budgets = goals.select("source", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"))
    edges = thresholds(sized, budgets.where("budget > 0"), few)
    plan = _on_source(goals, edges, few, "left")
    chosen = (F.col("hash") < F.col("threshold")) | ((F.col("hash") == F.col("threshold")) & F.col("with_edge"))
    copies = F.col("passes") + F.coalesce(chosen, F.lit(False)).cast("long")
    return (
        _on_source(sized, cut_lineage(plan), few)
        .withColumn("copies", F.least(copies, F.lit(most).cast("long")))
        .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it was taken; ``mixed`` has doc_id, source and copies.

    Rows that share an id and a source were taken equally often.
    """
    wanted = mixed.where("copies > 0").groupBy("doc_id", "source").agg(F.max("copies").alias("copies"))
    wanted = wanted.select(
        F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.array_repeat(F.lit(True), F.col("copies").cast("int")).alias("mix_copies")
    )
    same = docs["doc_id"].eqNullSafe(wanted["mix_id"]) & docs["source"].eqNullSafe(wanted["mix_source"])
    return docs.join(wanted, same).select(*[docs[c] for c in docs.columns], F.explode("mix_copies").alias("mix_one")).drop("mix_one")
