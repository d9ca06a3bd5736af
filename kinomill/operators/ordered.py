"""Ordered computations inside groups that may be very uneven.

``Window.partitionBy(key)`` puts a whole key in one task. When one key holds a
large share of the rows that task becomes the job. Here, rows are range
partitioned by key and order, so a large key is cut by Spark's own range
partitioner into as many pieces as it fills partitions, and small keys share
one. Each (key, piece) is one window partition, and what a piece needs from the
others (an offset, a last value, a few preceding rows) comes from a small side table.

The partitioned rows are written once to a reliable checkpoint: pieces stay what
they are however often a task is repeated, and the input is not read again. Rows that tie
on the order are cut like others, by a number that is written with them.

Neighbouring pieces share at most one key. Of n pieces, fewer than n keys
therefore reach over a border, in fewer than 2n pieces altogether: that bounds
everything broadcast below by the number of shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import cut_lineage
from . import quantiles

PIECE = "__piece"
HALO = "__halo"
TIE = "__tie"


def range_pieces(df: DataFrame, by: Sequence[str], order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """``df`` with its piece number and a number that orders ties; written once."""
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"`{c}`" for c in dict.fromkeys([*by, *order])]
    dealt = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(n, *keys, TIE)
    return cut_lineage(dealt.withColumn(PIECE, F.spark_partition_id()))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left key columns."""
    if not on:
        raise ValueError("a join needs at least one key column")
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{c}") for c in on],
        *[F.col(f"`{c}`") for c in right.columns if c not in on],
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(renamed[f"__r_{c}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def _across(per_piece: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of keys in several pieces, with the number of the piece among those of its key, from 0."""
    key = Window.partitionBy(*by)
    counted = per_piece.withColumn("__pieces", F.count(F.lit(1)).over(key))
    numbered = counted.withColumn("__nth", F.row_number().over(key.orderBy(PIECE)) - 1)
    return numbered.where("__pieces > 1")


def _before(by):
    return Window.partitionBy(*by).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)


def _after(by):
    return Window.partitionBy(*by).orderBy(PIECE).rowsBetween(1, Window.unboundedFollowing)


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    upto: str = "upto",
    total: str = "total",
    pieces: int | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` (this row included) and the group sum.

    Rows that tie on ``order`` get running sums in an arbitrary order among
    themselves, so callers pass an order without ties.
    """
    by = tuple(by)
    placed = range_pieces(df, by, order, pieces)
    piece = Window.partitionBy(*by, PIECE)
    running = piece.orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select(*df.columns, PIECE, F.sum(value).over(running).alias(upto), F.sum(value).over(piece).alias(total))
    per_piece = placed.groupBy(*by, PIECE).agg(F.sum(value).alias("__sum"))
    carried = _across(per_piece, by).select(
        *by,
        PIECE,
        F.coalesce(F.sum("__sum").over(_before(by)), F.lit(0)).alias("__carry_before"),
        F.sum("__sum").over(Window.partitionBy(*by)).alias("__carry_total"),
    )
    joined = null_safe_join(summed, F.broadcast(carried), (*by, PIECE), "left")
    return joined.select(
        *[c for c in df.columns if c not in (upto, total)],
        (F.col(upto) + F.coalesce("__carry_before", F.lit(0))).alias(upto),
        F.coalesce("__carry_total", total).alias(total),
    )


def neighbours(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    position: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add ``__prev_c`` and ``__next_c``: nearest non-null value on each side.

    With ``position`` each is a struct (value, at) carrying that column too.
    """
    by, order = tuple(by), (*order, TIE)
    placed = range_pieces(df, by, order[:-1], pieces)

    def carried_value(c) -> Column:
        at = F.col(f"`{position}`") if position else F.lit(0)
        return F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.col(f"`{c}`").alias("value"), at.alias("at")))

    ordered = Window.partitionBy(*by, PIECE).orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    later = ordered.rowsBetween(1, Window.unboundedFollowing)
    found = placed.select(
        *df.columns,
        PIECE,
        *[F.last(carried_value(c), ignorenulls=True).over(earlier).alias(f"__prev_{c}") for c in columns],
        *[F.first(carried_value(c), ignorenulls=True).over(later).alias(f"__next_{c}") for c in columns],
    )
    spot = F.struct(*order)
    edges = []
    for i, c in enumerate(columns):
        present = F.when(F.col(f"`{c}`").isNotNull(), spot)
        edges.append(F.max_by(carried_value(c), present).alias(f"__l{i}"))
        edges.append(F.min_by(carried_value(c), present).alias(f"__f{i}"))
    across = _across(placed.groupBy(*by, PIECE).agg(*edges) if edges else placed.select(*by, PIECE).distinct(), by)
    carries = []
    for i in range(len(columns)):
        carries.append(F.last(f"__l{i}", ignorenulls=True).over(_before(by)).alias(f"__before{i}"))
        carries.append(F.first(f"__f{i}", ignorenulls=True).over(_after(by)).alias(f"__after{i}"))
    joined = null_safe_join(found, F.broadcast(across.select(*by, PIECE, *carries)), (*by, PIECE), "left")
    return joined.select(
        *df.columns,
        *[F.coalesce(f"__prev_{c}", f"__before{i}").alias(f"__prev_{c}") for i, c in enumerate(columns)],
        *[F.coalesce(f"__next_{c}", f"__after{i}").alias(f"__next_{c}") for i, c in enumerate(columns)],
    )


def with_halo(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int, pieces: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Make frames of the last ``rows`` rows computable piece by piece.

    Returns the frame with a ``__halo`` flag (and ``__tie``, the last thing to order by) and
    the columns to partition the window by. Each piece also gets copies
    (``__halo`` true) of the ``rows`` rows before it; drop these after the window.
    """
    by = tuple(by)
    placed = range_pieces(df, by, order, pieces)
    across = _across(placed.select(*by, PIECE).distinct(), by).select(*by, PIECE, "__nth", "__pieces")
    backwards = [F.col(f"`{c}`").desc() for c in (*order, TIE)]
    from_end = Window.partitionBy(*by, PIECE).orderBy(*backwards)
    tails = null_safe_join(placed, F.broadcast(across), (*by, PIECE), "inner")
    tails = tails.withColumn("__back", F.row_number().over(from_end)).where(F.col("__back") <= rows).drop("__back", PIECE)
    # Each piece has at least one row, so a row is among the last ``rows`` before at most that many later pieces.
    reach = F.least(F.col("__nth") + rows, F.col("__pieces") - 1)
    sent = tails.where(F.col("__nth") < F.col("__pieces") - 1).withColumn("__nth", F.explode(F.sequence(F.col("__nth") + 1, reach)))
    to_piece = null_safe_join(sent.drop("__pieces"), F.broadcast(across.drop("__pieces")), (*by, "__nth"), "inner").drop("__nth")
    to_piece = to_piece.withColumn("__back", F.row_number().over(from_end)).where(F.col("__back") <= rows).drop("__back")
    both = placed.withColumn(HALO, F.lit(False)).unionByName(to_piece.withColumn(HALO, F.lit(True)))
    return both, [*by, PIECE]


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = False,
    names: Sequence[str] | None = None,
    **limits,
) -> DataFrame:
    """Exact quantiles per group: of numbers by bracket and count, of other types from a histogram and its running counts.

    Discrete quantile: smallest value whose share of rows reaches p. With
    ``interpolate``, the linear one between the two neighbouring ranks. NULLs
    are left out. No group is held in one task's memory.
    """
    if isinstance(df.schema[column].dataType, NumericType):
        return quantiles.exact_quantiles(df, column, probs, by, interpolate, names)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    by = list(by)
    values = df.where(F.col(f"`{column}`").isNotNull())
    counts = values.groupBy(*by, F.col(f"`{column}`").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_total(counts, by, ["__v"], "__n", "__upto", "__total", **limits)

    def at_rank(rank):
        return F.max(F.when((F.col("__upto") >= rank) & (F.col("__upto") - F.col("__n") < rank), F.col("__v")))

    picked = []
    for p, name in zip(probs, names):
        if interpolate:
            spot = (F.col("__total") - 1) * F.lit(float(p))
            low, high = at_rank(F.floor(spot) + 1), at_rank(F.ceil(spot) + 1)
            weight = F.max(spot - F.floor(spot))
            picked.append((low + (high - low) * weight).alias(name))
        else:
            picked.append(at_rank(F.greatest(F.ceil(F.col("__total") * F.lit(float(p))), F.lit(1))).alias(name))
    return ranked.groupBy(*by).agg(*picked)
