"""How many entities score better than a triple's own: counted by balls, scored only where a ball's bounds overlap.

A TransH score is minus a squared distance on the relation's plane, and projecting onto a plane never lengthens a
distance. So one set of balls over the entities serves all relations: with the centre c and the radius of a ball, every entity of it
lies, on any plane, within the radius of c's projection. A ball wholly nearer than the query's own distance is counted in whole, a ball
wholly farther not at all.

Entities are dealt to pivots (a hash-chosen sample of bounded size), the nearest one; what a pivot attracts is cut into blocks
of bounded size. Queries meet the table of blocks (pivot, radius, number: a short row per block) and are sent on to those blocks alone whose
bounds overlap. There a tree of balls over the block's entities does the same again, down to leaves whose
entities are scored by matrix products. Query rows carry their number of candidates scored, so the gain can be read off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK_ENTITIES = 32_768
PIVOTS = 256  # at most; with their vectors they go to every task that deals entities
LEAF = 64
QUERIES_AT_ONCE = 256
SLACK = 1e-6  # bounds are loosened by this share, far more than scores are rounded by


def _matrix(column) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype("float64")


def _blocks(entities: DataFrame, count: int, block: int) -> tuple[DataFrame, np.ndarray, list]:
    """(id, vector, pivot, part) of each entity, the pivots, and (pivot, part, radius, n) of each block, of which pivot is the centre."""
    wanted = min(PIVOTS, max(1, math.ceil(count / block)))
    bound = int(min(1.0, 4.0 * wanted / max(count, 1)) * (1 << 30)) + 1
    drawn = entities.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < bound).orderBy(F.xxhash64("id"), "id").limit(wanted)
    rows = drawn.collect() or entities.orderBy("id").limit(1).collect()  # PIVOTS vectors at most
    if not rows:
        return entities.select("id", "vector", F.lit(0).alias("pivot"), F.lit(0).alias("part")), np.zeros((0, 0)), []
    pivots = np.array([r["vector"] for r in rows], dtype="float64")
    kinds = {f.name: f.dataType.simpleString() for f in entities.schema.fields}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                e = _matrix(b.column("vector"))
                pivot = ((pivots * pivots).sum(axis=1)[None, :] - 2 * e @ pivots.T).argmin(axis=1)
                away = np.linalg.norm(e - pivots[pivot], axis=1)
                columns = [b.column("id"), b.column("vector"), pa.array(pivot.astype(np.int32)), pa.array(away)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "pivot", "away"])

    dealt = entities.select("id", "vector").mapInArrow(deal, f"id {kinds['id']}, vector {kinds['vector']}, pivot int, away double")
    dealt = cut_lineage(dealt)
    sizes = dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    # A pivot that attracts much is cut into parts of about the same size.
    placed = dealt.join(F.broadcast(sizes), "pivot").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    balls = placed.groupBy("pivot", "part").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
    return placed.select("id", "vector", "pivot", "part"), pivots, balls.orderBy("pivot", "part").collect()


class Ball:
    """A tree of balls over the rows of a matrix: an inner node halves its rows between two far ones."""

    __slots__ = ("centre", "radius", "rows", "inner")

    def __init__(self, e: np.ndarray, rows: np.ndarray, leaf: int):
        own = e[rows]
        self.centre = own.mean(axis=0)
        away = np.linalg.norm(own - self.centre, axis=1)
        self.radius, self.rows, self.inner = float(away.max()), rows, ()
        if len(rows) > leaf and self.radius > 0:
            a = own[away.argmax()]
            b = own[np.linalg.norm(own - a, axis=1).argmax()]
            side = own @ (b - a)
            half = np.argsort(side, kind="stable")
            self.inner = Ball(e, rows[half[: len(rows) // 2]], leaf), Ball(e, rows[half[len(rows) // 2 :]], leaf)


def _standing(q: np.ndarray, w: np.ndarray, own: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query and ball: whether all of the ball is nearer than the own distance, and whether some of it may be as near."""
    along, at = w @ centres.T, np.einsum("ij,ij->i", q, w)[:, None]
    squares = (q * q).sum(axis=1)[:, None] - 2 * (q @ centres.T - along * at) + (centres * centres).sum(axis=1)[None, :] - along**2
    size = 1 + (q * q).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :]
    gap, limit = np.sqrt(np.maximum(squares, 0)), np.sqrt(np.maximum(-own, 0))[:, None]
    slack = SLACK * np.sqrt(size) + radii[None, :] * SLACK
    return gap + radii[None, :] + slack < limit, gap - radii[None, :] - slack <= limit


def _met(comparable, names: list[str], leaf: int):
    """Counts of one block for the queries sent there."""

    def run(key, queries: pa.Table, entities: pa.Table) -> pa.Table:
        found = queries.select(names)
        better, ties, scored = np.zeros((3, queries.num_rows), np.int64)
        better += queries.column("base").to_numpy()
        if queries.num_rows and entities.num_rows:
            e, ids = _matrix(entities.column("vector")), entities.column("id").to_numpy()
            top = Ball(e, np.arange(len(e)), leaf)
            all_q, all_w = _matrix(queries.column("q")), _matrix(queries.column("w"))
            all_own, targets = queries.column("score").to_numpy(), queries.column("target").to_numpy()
            for at in range(0, queries.num_rows, QUERIES_AT_ONCE):
                here = np.arange(at, min(at + QUERIES_AT_ONCE, queries.num_rows))
                todo = [(top, here)]
                while todo:
                    ball, who = todo.pop()
                    q, w, own = all_q[who], all_w[who], all_own[who]
                    nearer, near = _standing(q, w, own, ball.centre[None, :], np.array([ball.radius]))
                    better[who[nearer[:, 0]]] += len(ball.rows)
                    open_ = near[:, 0] & ~nearer[:, 0]
                    who = who[open_]
                    if not len(who):
                        continue
                    if ball.inner:
                        todo += [(inner, who) for inner in ball.inner]
                        continue
                    q, w, own, part = all_q[who], all_w[who], all_own[who][:, None], e[ball.rows]
                    along = w @ part.T
                    product = q @ part.T - along * np.einsum("ij,ij->i", q, w)[:, None]
                    scores = comparable(-((q * q).sum(axis=1)[:, None] - 2 * product + (part * part).sum(axis=1)[None, :] - along**2))
                    other = targets[who][:, None] != ids[ball.rows][None, :]
                    better[who] += ((scores > own) & other).sum(axis=1)
                    ties[who] += ((scores == own) & other).sum(axis=1)
                    scored[who] += len(ball.rows)
        for name, values in (("better", better), ("ties", ties), ("scored", scored)):
            found = found.append_column(name, pa.array(values))
        return found

    return run


def _sent(pivots: np.ndarray, table: list, columns: list[str]):
    """Query rows for the blocks whose bounds overlap; the first row of a query has what blocks wholly nearer hold."""
    pivot, part, radius, n = (np.array([r[c] for r in table]) for c in ("pivot", "part", "radius", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES_AT_ONCE):
                b = whole.slice(at, QUERIES_AT_ONCE)
                nearer, near = _standing(_matrix(b.column("q")), _matrix(b.column("w")), b.column("score").to_numpy(), pivots[pivot], radius)
                who, to = np.nonzero(near & ~nearer)
                first = np.append(True, who[1:] != who[:-1]) if len(who) else np.zeros(0, bool)
                base = np.where(first, (nearer @ n)[who], 0)
                out = b.take(pa.array(who))
                added = [pa.array(pivot[to].astype(np.int32)), pa.array(part[to].astype(np.int32)), pa.array(base.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*[out.column(c) for c in columns], *added], [*columns, "pivot", "part", "base"])

    return run


def count_better(
    queries: DataFrame, entities: DataFrame, comparable, n_queries: int, query_block: int, block: int = BLOCK_ENTITIES, leaf: int = LEAF
) -> DataFrame:
    """(h_id, r_id, t_id, side, better, ties, scored) of each query (these, target, score, q, w) among ``entities`` (id, vector).

    A query's target is an entity at the query's own distance, so at least its block overlaps and no query is lost.
    """
    names = ["h_id", "r_id", "t_id", "side"]
    placed, pivots, table = _blocks(entities, entities.count(), block)
    kinds = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    columns = [*names, "target", "score", "q", "w"]
    listed = ", ".join(f"{c} {kinds[c]}" for c in columns)
    counts = ", ".join(f"{c} {kinds[c]}" for c in names) + ", better bigint, ties bigint, scored bigint"
    if not table:
        return queries.select(*names, *[F.lit(0).cast("long").alias(c) for c in ("better", "ties", "scored")])
    sent = queries.select(*columns).mapInArrow(_sent(pivots, table, columns), f"{listed}, pivot int, part int, base bigint")
    # Many queries for one block are met in several groups.
    groups = max(1, math.ceil(n_queries / query_block))
    left = sent.withColumn("qb", F.pmod(F.xxhash64(*names), F.lit(groups)).cast("int"))
    right = placed.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    key = ["pivot", "part", "qb"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_met(comparable, names, leaf), counts)
    return met.groupBy(*names).agg(*[F.sum(c).alias(c) for c in ("better", "ties", "scored")])
