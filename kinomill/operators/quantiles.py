"""Exact quantiles by bracket and count: a sketch says about where a rank lies, a second pass counts, and only the bracket is sorted.

The first pass keeps one KLL sketch per group, which is mergeable, so it is summed in the tasks before anything moves. Around
each wanted rank it gives two values, the bracket. The second pass counts what lies below and keeps a histogram of what lies
inside; with these the rank is read off exactly. A sketch may miss: a rank that is not inside its bracket is looked for
again without that border. Brackets that still hold more than ``MOST`` different values are narrowed by a sketch of
their own. No rows are range-partitioned, sorted or written; what is written are the brackets' histograms.

Values are told apart by the sketch as doubles; larger integers and decimals that fall together there lie in one bracket
and are ordered by their own type. NaN comes after all numbers, NULL is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SKETCH_SIZE = 800
STEPS = 100  # a step is well above twice the rank error of a sketch of this size
MOST = 200_000
FEW_GROUPS = 10_000


def _key(value: Column) -> Column:
    number = value.cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def _on(left: DataFrame, right: DataFrame, by: Sequence[str], few: bool = False) -> DataFrame:
    """Join with one row per group, in which NULL groups match; without groups ``right`` is one row, taken as constants.

    ``few`` groups are broadcast: a join by the group would sort all rows of a group in one task.
    """
    if not by:
        row = right.first()
        constants = {f.name: F.lit(row[f.name] if row else None).cast(f.dataType) for f in right.schema.fields}
        return (left if row else left.where(F.lit(False))).withColumns(constants)
    renamed = right.select(*[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(by)], *[c for c in right.columns if c not in by])
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}"))
    return left.join(F.broadcast(renamed) if few else renamed, same).drop(*[f"__g{i}" for i in range(len(by))])


def _ranks(probs: Sequence[float], interpolate: bool) -> list[Column]:
    """Ranks wanted of ``__total`` values, two for each probability if values in between are interpolated."""
    out = []
    for p in probs:
        if interpolate:
            spot = (F.col("__total") - 1) * F.lit(float(p))
            out += [F.floor(spot) + 1, F.ceil(spot) + 1]
        else:
            out.append(F.greatest(F.ceil(F.col("__total") * F.lit(float(p))), F.lit(1)))
    return [r.cast("long") for r in out]


def _borders(sketch: Column, rank: Column, size: Column) -> tuple[Column, Column]:
    """Values at least a step of ``STEPS`` below and above the rank, without a border where that is outside."""
    marks = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    share = rank * F.lit(STEPS) / size
    low, high = F.floor(share).cast("int") - 1, F.ceil(share).cast("int") + 1
    return (
        F.when(low < 0, F.lit(float("-inf"))).otherwise(F.get(marks, low)),
        F.when(high > STEPS, F.lit(float("inf"))).otherwise(F.get(marks, high)),
    )


def _inside(i: int) -> Column:
    return (F.col("__key") >= F.col(f"__low{i}")) & (F.col("__key") <= F.col(f"__high{i}"))


def _counted(values: DataFrame, brackets: DataFrame, by: Sequence[str], n: int, few: bool) -> DataFrame:
    """Per group and value inside a bracket how often it occurs; one more row per group, without a value, for all others."""
    met = _on(values, brackets, by, few)
    any_inside = F.lit(False)
    for i in range(n):
        any_inside = any_inside | _inside(i)
    kept = met.withColumn("__at", F.when(any_inside, F.col("__v")))
    below = [F.sum((F.col("__key") < F.col(f"__low{i}")).cast("long")).alias(f"__below{i}") for i in range(n)]
    return kept.groupBy(*by, "__at").agg(F.count(F.lit(1)).alias("__n"), *below)


def _judged(counted: DataFrame, brackets: DataFrame, by: Sequence[str], n: int, few: bool) -> DataFrame:
    """Brackets with what lies below and inside each, and how many different values that are."""
    own = _on(counted.withColumn("__key", _key(F.col("__at"))), brackets, by, few)
    sums = []
    for i in range(n):
        here = F.col("__at").isNotNull() & _inside(i)
        sums += [
            F.sum(f"__below{i}").alias(f"__below{i}"),
            F.coalesce(F.sum(F.when(here, F.col("__n"))), F.lit(0)).alias(f"__in{i}"),
            F.sum(here.cast("long")).alias(f"__different{i}"),
        ]
    kept = [f"__{name}{i}" for i in range(n) for name in ("rank", "low", "high")]
    return own.groupBy(*by, "__total", *kept).agg(*sums)


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = False,
    names: Sequence[str] | None = None,
    most: int = MOST,
    sketch_size: int = SKETCH_SIZE,
) -> DataFrame:
    """Exact quantiles per group of a numeric column.

    Discrete quantile: smallest value whose share of rows reaches p. With ``interpolate``, the linear one between the
    two neighbouring ranks. Groups without a value give no row; without groups, a table without values gives one row of NULLs.
    """
    names, by = list(names or [f"q{i}" for i in range(len(probs))]), list(by)
    value = F.col(f"`{column}`")
    values = df.where(value.isNotNull()).select(*[F.col(f"`{c}`") for c in by], value.alias("__v"), _key(value).alias("__key"))
    ranks = _ranks(probs, interpolate)
    n = len(ranks)
    sketched = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__total"), F.kll_sketch_agg_double("__key", F.lit(sketch_size)).alias("__sketch")
    )
    columns = []
    for i, rank in enumerate(ranks):
        low, high = _borders(F.col("__sketch"), rank, F.col("__total"))
        columns += [rank.alias(f"__rank{i}"), low.alias(f"__low{i}"), high.alias(f"__high{i}")]
    brackets = cut_lineage(sketched.where("__total > 0").select(*by, "__total", *columns))
    few = bool(by) and brackets.count() <= FEW_GROUPS
    while True:
        counted = cut_lineage(_counted(values, brackets, by, n, few))
        judged = cut_lineage(_judged(counted, brackets, by, n, few))
        low_miss = [F.col(f"__rank{i}") <= F.col(f"__below{i}") for i in range(n)]
        high_miss = [F.col(f"__rank{i}") > F.col(f"__below{i}") + F.col(f"__in{i}") for i in range(n)]
        # Equal borders cannot be narrowed: what is inside are values that are one double.
        wide = [(F.col(f"__different{i}") > most) & (F.col(f"__low{i}") < F.col(f"__high{i}")) for i in range(n)]
        again = F.lit(False)
        for condition in (*low_miss, *high_miss, *wide):
            again = again | condition
        if judged.where(again).isEmpty():
            break
        inside = _on(values, judged, by, few)
        sketches = [F.kll_sketch_agg_double(F.when(_inside(i), F.col("__key")), F.lit(sketch_size)).alias(f"__sketch{i}") for i in range(n)]
        known = [c for c in judged.columns if c not in by]
        narrowed = inside.groupBy(*by, *known).agg(*sketches)
        columns = []
        for i in range(n):
            miss = low_miss[i] | high_miss[i]
            low, high = _borders(F.col(f"__sketch{i}"), F.col(f"__rank{i}") - F.col(f"__below{i}"), F.col(f"__in{i}"))
            keep_low, keep_high = F.col(f"__low{i}"), F.col(f"__high{i}")
            new_low = F.when(low_miss[i], F.lit(float("-inf"))).when(miss | ~wide[i], keep_low).otherwise(F.greatest(low, keep_low))
            new_high = F.when(high_miss[i], F.lit(float("inf"))).when(miss | ~wide[i], keep_high).otherwise(F.least(high, keep_high))
            columns += [f"__rank{i}", new_low.alias(f"__low{i}"), new_high.alias(f"__high{i}")]
        brackets = cut_lineage(narrowed.select(*by, "__total", *columns))
    return _read_off(counted, judged, by, n, probs, interpolate, names, few)


def _read_off(counted, judged, by, n, probs, interpolate, names, few):
    """The values at the ranks, from running counts over each bracket's histogram."""
    inside = _on(counted.where(F.col("__at").isNotNull()).select(*by, "__at", "__n", _key(F.col("__at")).alias("__key")), judged, by, few)
    found = []
    for i in range(n):
        upto = F.col(f"__below{i}") + F.sum(F.when(_inside(i), F.col("__n")).otherwise(0)).over(
            Window.partitionBy(*by).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
        )
        inside = inside.withColumn(f"__upto{i}", upto)
        here = _inside(i) & (F.col(f"__upto{i}") >= F.col(f"__rank{i}")) & (F.col(f"__upto{i}") - F.col("__n") < F.col(f"__rank{i}"))
        found.append(F.max(F.when(here, F.col("__at"))))
    if not interpolate:
        return inside.groupBy(*by).agg(*[f.alias(name) for f, name in zip(found, names)])
    picked = []
    for i, (p, name) in enumerate(zip(probs, names)):
        spot = (F.col("__total") - 1) * F.lit(float(p))
        low, high = found[2 * i], found[2 * i + 1]
        picked.append((low + (high - low) * F.max(spot - F.floor(spot))).alias(name))
    return inside.groupBy(*by).agg(*picked)
