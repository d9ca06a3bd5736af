"""Link-prediction ranks and their summary metrics.

Ranking a triple means placing all entities by their score in its head or tail place. That is counted, not listed:
``balls`` counts groups of entities whose bounds lie wholly on one side of the query's own score and scores the others in small
matrix products, so that scored pairs are never rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .balls import count_better
from .embeddings import minus, on_hyperplane, plus, score_transh
from .ordered import exact_quantiles, null_safe_join, running_total

# Queries and entities that meet in one task.
QUERY_BLOCK = 16_384
ENTITY_BLOCK = 32_768
DIGITS = 9  # significant digits in which scores are compared
HITS_AT = (1, 3, 5, 10)

# Fixed value: scales the median absolute deviation to a normal standard deviation.
MAD_SCALE = 1.482602218505602


def comparable(score: Column) -> Column:
    """The score in DIGITS significant digits (half to even), so that tiny vectors are told apart as well as large ones."""
    unit = F.pow(F.lit(10.0), DIGITS - 1 - F.floor(F.log10(F.abs(score))))
    return F.when(score == 0, F.lit(0.0)).otherwise(F.rint(score * unit) / unit)


def _comparable(scores: np.ndarray) -> np.ndarray:
    """The same for an array."""
    size = np.abs(scores)
    unit = 10.0 ** (DIGITS - 1 - np.floor(np.log10(np.where(size > 0, size, 1.0))))
    return np.rint(scores * unit) / unit


def _queries(triples: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Two rows per triple, one per side: the vector the candidate should meet on the plane."""
    head = entities.select(F.col("id").alias("h_id"), F.col("vector").alias("h"))
    tail = entities.select(F.col("id").alias("t_id"), F.col("vector").alias("t"))
    full = (
        triples.select("h_id", "r_id", "t_id")
        .distinct()
        .join(head, "h_id")
        .join(tail, "t_id")
        .join(relations.select(F.col("id").alias("r_id"), "w", "d"), "r_id")
    )
    scored = score_transh(full).withColumn("score", comparable(F.col("score")))
    h_plane, t_plane = on_hyperplane(F.col("h"), F.col("w")), on_hyperplane(F.col("t"), F.col("w"))
    sides = F.array(
        F.struct(
            F.lit("tail").alias("side"), F.col("h_id").alias("anchor"), F.col("t_id").alias("target"),
            plus(h_plane, F.col("d")).alias("q"),
        ),
        F.struct(
            F.lit("head").alias("side"), F.col("t_id").alias("anchor"), F.col("h_id").alias("target"),
            minus(t_plane, F.col("d")).alias("q"),
        ),
    )
    return scored.select("h_id", "r_id", "t_id", "score", "w", F.inline(sides))


def counted_candidates(
    triples: DataFrame, entities: DataFrame, relations: DataFrame, query_block: int = QUERY_BLOCK, entity_block: int = ENTITY_BLOCK
) -> tuple[DataFrame, int]:
    """Per triple and side how many entities score better and equal, and of how many the score was taken; and the number of entities."""
    queries = _queries(triples, entities, relations)
    row = triples.select(F.count(F.lit(1)).alias("n")).first(), entities.select(F.count(F.lit(1)).alias("n")).first()
    return count_better(queries, entities, _comparable, 2 * row[0]["n"], query_block, entity_block), row[1]["n"]


def rank_triples(
    triples: DataFrame,
    entities: DataFrame,
    relations: DataFrame,
    known: DataFrame | None = None,
    query_block: int = QUERY_BLOCK,
    entity_block: int = ENTITY_BLOCK,
    **limits,
) -> DataFrame:
    """Filtered ranks of test triples among all entities, for the head and the tail place.

    ``triples`` (h_id, r_id, t_id); ``entities`` (id, vector); ``relations``
    (id, w, d); other true triples in ``known`` do not count against a triple.
    """
    counted, size = counted_candidates(triples, entities, relations, query_block, entity_block)
    raw = counted.drop("scored")

    true = triples.select("h_id", "r_id", "t_id")
    if known is not None:
        true = true.unionByName(known.select("h_id", "r_id", "t_id"))
    standing = _standing_among_known(_queries(true, entities, relations), **limits)
    ranked = raw.join(standing, ["h_id", "r_id", "t_id", "side"])
    better = F.col("better") - F.col("known_better")
    ties = F.col("ties") - F.col("known_ties")
    return ranked.select(
        "h_id",
        "r_id",
        "t_id",
        "side",
        (better + 1).alias("optimistic"),
        (better + 1 + ties).alias("pessimistic"),
        (better + 1 + ties / 2).alias("realistic"),
        (F.lit(size) - F.col("known_total") + 1).alias("candidates"),
    )


def _standing_among_known(known: DataFrame, **limits) -> DataFrame:
    """For each true triple: how many others with its anchor and relation score higher or equal.

    Counted from score histograms with running totals; the members of an
    anchor, which may be very many, are never paired.
    """
    group = ["side", "r_id", "anchor"]
    histogram = known.groupBy(*group, "score").agg(F.count(F.lit(1)).alias("same"))
    summed = running_total(histogram, group, ["score"], "same", "upto", "known_total", **limits)
    return null_safe_join(known.drop("q", "w"), summed, [*group, "score"], "inner").select(
        "h_id",
        "r_id",
        "t_id",
        "side",
        (F.col("known_total") - F.col("upto")).alias("known_better"),
        (F.col("same") - 1).alias("known_ties"),
        "known_total",
    )


_HEAD_TERMS = 20


def _tail_sum(n: Column, a: Column) -> Column:
    """Euler-Maclaurin terms of the sum of j**a for j up to n, without the constant."""
    power = F.pow(n, a)
    return n * power / (a + 1) + power / 2 + a * power / (12 * n) - a * (a - 1) * (a - 2) * power / (720 * n * n * n)


def mean_power(n: Column, a: Column) -> Column:
    """Mean of j**a over 1..n for any a except -1; exact sum for small n."""
    n = n.cast("double")
    head = F.lit(0.0)
    exact = F.lit(0.0)
    for j in range(1, _HEAD_TERMS + 1):
        term = F.pow(F.lit(float(j)), a)
        head = head + term
        exact = exact + F.when(n >= j, term).otherwise(0.0)
    start = F.lit(float(_HEAD_TERMS))
    return F.when(n <= _HEAD_TERMS, exact).otherwise(head + _tail_sum(n, a) - _tail_sum(start, a)) / n


def mean_inverse(n: Column) -> Column:
    """Mean of 1/j over 1..n."""
    n = n.cast("double")
    exact = F.lit(0.0)
    for j in range(1, _HEAD_TERMS + 1):
        exact = exact + F.when(n >= j, F.lit(1.0 / j)).otherwise(0.0)
    series = F.log(n) + F.lit(0.5772156649015329) + 1 / (2 * n) - 1 / (12 * n * n) + 1 / (120 * n * n * n * n)
    return F.when(n <= _HEAD_TERMS, exact).otherwise(series) / n


def rank_metrics(ranks: DataFrame, adjusted_at: int = 10, **limits) -> DataFrame:
    """One row per side (head, tail, both) and rank kind (optimistic, realistic, pessimistic).

    Several passes need the ranks, so they are written to the checkpoint folder once.
    """
    ranks = cut_lineage(ranks)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("rank")) for k in ("optimistic", "realistic", "pessimistic")])
    sides = F.explode(F.array(F.col("side"), F.lit("both")))
    long = ranks.select(sides.alias("side"), "candidates", kinds.alias("__k")).select("side", "candidates", F.inline("__k"))
    group = ["side", "kind"]
    n, r = F.col("candidates"), F.col("rank")
    hit_chance = F.least(F.lit(float(adjusted_at)) / n, F.lit(1.0))
    inverse = mean_inverse(n)
    counted = long.groupBy(*group).agg(
        F.count(r).alias("count"),
        F.avg(r).alias("arithmetic_mean_rank"),
        F.exp(F.avg(F.log(r))).alias("geometric_mean_rank"),
        (1 / F.avg(1 / r)).alias("harmonic_mean_rank"),
        F.avg(1 / r).alias("inverse_harmonic_mean_rank"),
        F.stddev_pop(r).alias("standard_deviation"),
        F.var_pop(r).alias("variance"),
        *[F.avg((r <= k).cast("double")).alias(f"hits_at_{k}") for k in sorted({*HITS_AT, adjusted_at})],
        F.avg((n + 1) / 2).alias("__mean"),
        F.sum((n * n - 1) / 12).alias("__mean_var"),
        F.avg(hit_chance).alias("__hits"),
        F.sum(hit_chance * (1 - hit_chance)).alias("__hits_var"),
        F.avg(inverse).alias("__inv"),
        F.sum(mean_power(n, F.lit(-2.0)) - inverse * inverse).alias("__inv_var"),
    )
    # The expectation of a product of powers needs the number of ranks first.
    by_size = long.groupBy(*group, "candidates").agg(F.count(F.lit(1)).alias("__c"))
    sized = null_safe_join(by_size, counted.select(*group, "count"), group, "inner")
    share = 1 / F.col("count")
    geometric = sized.groupBy(*group).agg(
        F.exp(F.sum(F.col("__c") * F.log(mean_power(n, share)))).alias("__geo"),
        F.exp(F.sum(F.col("__c") * F.log(mean_power(n, 2 * share)))).alias("__geo2"),
    )
    medians = exact_quantiles(long, "rank", [0.5], group, interpolate=True, names=["median_rank"], **limits)
    centred = null_safe_join(long, medians, group, "inner").withColumn("__dev", F.abs(r - F.col("median_rank")))
    spread = exact_quantiles(centred, "__dev", [0.5], group, interpolate=True, names=["__mad"], **limits)
    joined = counted
    for more in (geometric, medians, spread):
        joined = null_safe_join(joined, more, group, "inner")

    amr, gmr, mrr, hits, m = (
        F.col(c) for c in ("arithmetic_mean_rank", "geometric_mean_rank", "inverse_harmonic_mean_rank", f"hits_at_{adjusted_at}", "count")
    )

    def z(gain, variance):
        return gain / F.sqrt(F.when(variance > 0, variance))

    def adjusted(value, expected):
        return (value - expected) / F.when(expected < 1, 1 - expected)

    return joined.select(
        *group,
        "count",
        "arithmetic_mean_rank",
        "geometric_mean_rank",
        "harmonic_mean_rank",
        "median_rank",
        (1 / amr).alias("inverse_arithmetic_mean_rank"),
        (1 / gmr).alias("inverse_geometric_mean_rank"),
        mrr,
        (1 / F.col("median_rank")).alias("inverse_median_rank"),
        *[f"hits_at_{k}" for k in HITS_AT],
        "standard_deviation",
        "variance",
        (F.lit(MAD_SCALE) * F.col("__mad")).alias("median_absolute_deviation"),
        (amr / F.col("__mean")).alias("adjusted_arithmetic_mean_rank"),
        (1 - (amr - 1) / F.when(F.col("__mean") > 1, F.col("__mean") - 1)).alias("adjusted_arithmetic_mean_rank_index"),
        (1 - (gmr - 1) / F.when(F.col("__geo") > 1, F.col("__geo") - 1)).alias("adjusted_geometric_mean_rank_index"),
        adjusted(hits, F.col("__hits")).alias("adjusted_hits_at_k"),
        adjusted(mrr, F.col("__inv")).alias("adjusted_inverse_harmonic_mean_rank"),
        z(F.col("__mean") - amr, F.col("__mean_var") / (m * m)).alias("z_arithmetic_mean_rank"),
        z(F.col("__geo") - gmr, F.col("__geo2") - F.col("__geo") * F.col("__geo")).alias("z_geometric_mean_rank"),
        z(hits - F.col("__hits"), F.col("__hits_var") / (m * m)).alias("z_hits_at_k"),
        z(mrr - F.col("__inv"), F.col("__inv_var") / (m * m)).alias("z_inverse_harmonic_mean_rank"),
    )
