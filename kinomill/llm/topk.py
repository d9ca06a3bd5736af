"""Exact top-k by inner product: vectors bucketed by length, pruned by local cosine thresholds, then verified.

Vectors are ordered by length (range partitions of the length, so equal vectors
do not pile up) and packed into buckets of neighbouring lengths. Each query first
meets one bucket, the one of the longest vectors, which gives a score that its
k-th result has at least. Query blocks are then sent to every bucket; there the
score divided by the lengths becomes a cosine threshold of that query and bucket.
Above 1 the bucket is skipped, a high one prunes by the coordinate in which the
query is strongest, a low one only by length; what is left is multiplied out in
whole numbers. A cell returns at most k rows per query, so cells x queries x k
small rows meet at the end, never pairs.

Defined results: vectors that are null, empty, or hold null or non-finite components take
no part, nor do vectors with a component so large that it is no finite double times ``scale``. Components beyond a vector's end count as zero. Ids that repeat are
candidates each; a null id is neither query nor candidate. Scores beyond 64 bits
are held at the bounds of a 64-bit number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomill.llm.common import task_count
from kinomill.session import cut_lineage

BUCKET_ROWS = 32_768
QUERY_ROWS = 1_024
COORDINATE_FROM = 0.8  # local cosine threshold from which pruning by coordinate pays
EXACT = 1 << 53
LARGEST = float(np.finfo(np.float64).max)
LONG = (-(1 << 63), (1 << 63) - 1)


def complete(vector: Column, scale: int = 256) -> Column:
    """The vector in doubles; null for vectors that take no part."""
    doubles = vector.cast("array<double>")
    # Also keeps out infinity, and NaN, which Spark orders above all numbers.
    good = F.forall(doubles, lambda x: x.isNotNull() & (F.abs(x) <= LARGEST / scale))
    return F.when(good & (F.size(vector) > 0), doubles)


BLOCK = "longest double, n long, width long, ids binary, vectors binary"


def _block(ids: list[int], vectors: list[np.ndarray], scale: int) -> pa.RecordBatch:
    """One block of vectors, longest first."""
    width = max(map(len, vectors))
    m = np.zeros((len(ids), width))
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    m = np.floor(m * scale)
    norms = np.sqrt((m * m).sum(1))
    order = np.lexsort((ids, -norms))
    data = np.asarray(ids, np.int64)[order].tobytes(), m[order].tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([float(norms.max())]), *(pa.array([x], pa.int64()) for x in (len(ids), width)), *(pa.array([x], pa.binary()) for x in data)],
        names=[x.split()[0] for x in BLOCK.split(", ")],
    )


def _vectors(lists: pa.ListArray) -> list[np.ndarray]:
    return np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())[:-1])


def _packed(rows: DataFrame, per_block: int, scale: int) -> DataFrame:
    """Blocks of up to ``per_block`` vectors of a partition."""

    def pack(batches):
        ids, vectors = [], []
        for batch in batches:
            vectors.extend(_vectors(batch.column("vector")))
            ids.extend(batch.column("vec_id").to_pylist())
            while len(ids) >= per_block:
                yield _block(ids[:per_block], vectors[:per_block], scale)
                ids, vectors = ids[per_block:], vectors[per_block:]
        if ids:
            yield _block(ids, vectors, scale)

    return rows.select("vec_id", "vector").mapInArrow(pack, BLOCK)


def _query_blocks(asked: DataFrame, blocks: int, scale: int) -> DataFrame:
    """Queries in ``blocks`` blocks by a hash of their ids, so that their number does not depend on the partitions."""

    def pack(table: pa.Table) -> pa.Table:
        lists = table.column("vector").combine_chunks()
        made = _block(table.column("vec_id").to_pylist(), _vectors(lists), scale)
        return pa.Table.from_batches([made]).add_column(0, "block", table.column("block").slice(0, 1))

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return dealt.select("block", "vec_id", "vector").groupBy("block").applyInArrow(pack, f"block long, {BLOCK}")


def _unpack(n, width, ids, vectors):
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(n, width)


def _best(ids, scores, k):
    """The k best by score, ties to the smaller id."""
    order = np.lexsort((ids, -scores if scores.dtype != object else [-s for s in scores]))[:k]
    return ids[order], scores[order]


def search_cell(q_ids, q, floor, p_ids, p, k):
    """Per query of a block, the best of one bucket with at least ``floor``; yields (query_id, ids, scores).

    ``p`` is ordered by falling length. Pruning bounds are loosened by 1e-9 so that rounding loses nothing.
    """
    width = max(q.shape[1], p.shape[1])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    p = np.pad(p, ((0, 0), (0, width - p.shape[1])))
    q_norm, p_norm = np.sqrt((q * q).sum(1)), np.sqrt((p * p).sum(1))
    exact = float(q_norm.max(initial=0)) * float(p_norm.max(initial=0)) < EXACT / 2
    if not exact:  # whole numbers of any size
        q_big, p_big = (np.array([[int(x) for x in row] for row in m], dtype=object) for m in (q, p))
    longest = p_norm[0] if len(p_norm) else 0.0
    unit = p / np.maximum(p_norm, 1e-300)[:, None]
    for i, query_id in enumerate(q_ids):
        at_least, keep = floor[i], slice(None)
        if np.isfinite(at_least) and at_least > 0 and exact:
            if q_norm[i] * longest * (1 + 1e-9) < at_least:
                continue  # the whole bucket is too short
            prefix = int(np.searchsorted(-p_norm, -at_least / q_norm[i] * (1 - 1e-9), side="right"))
            local = at_least / (q_norm[i] * longest)
            if local >= COORDINATE_FROM:
                # cos(q, p) <= x*y + sqrt(1-x^2)*sqrt(1-y^2) for the coordinates x, y of both on one axis.
                axis = int(np.abs(q[i]).argmax())
                x, y = q[i, axis] / q_norm[i], unit[:prefix, axis]
                bound = x * y + np.sqrt(max(0.0, 1 - x * x)) * np.sqrt(np.maximum(0, 1 - y * y))
                keep = np.flatnonzero(bound * p_norm[:prefix] * q_norm[i] * (1 + 1e-9) >= at_least)
            else:
                keep = slice(0, prefix)
        found = p_ids[keep]
        if exact:
            scores = (p[keep] @ q[i]).astype(np.int64)
        else:
            scores = p_big[keep] @ q_big[i] if len(found) else np.array([], dtype=object)
            scores = np.array([min(max(s, LONG[0]), LONG[1]) for s in scores], dtype=object)
        mask = found != query_id
        if np.isfinite(at_least):
            mask &= scores >= at_least
        ids, best = _best(found[mask], scores[mask], k)
        if len(ids):
            yield query_id, ids, best


OUT = "query_id long, vec_id long, score long"
_OUT_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_SIDE = ("n", "width", "ids", "vectors")


def _search(cells: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _unpack(*[row[f"q_{c}"] for c in _SIDE])
                p_ids, p = _unpack(*[row[c] for c in _SIDE])
                floor = np.frombuffer(row["floor"]) if row["floor"] is not None else np.full(len(q_ids), -np.inf)
                a, b, c = [], [], []
                for query_id, ids, scores in search_cell(q_ids, q, floor, p_ids, p, k):
                    a += [int(query_id)] * len(ids)
                    b += ids.tolist()
                    c += [int(s) for s in scores]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], schema=_OUT_SCHEMA)

    return cells.mapInArrow(run, OUT)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    valid = vectors.select("vec_id", complete(F.col("embedding"), scale).alias("vector")).where("vec_id is not null and vector is not null")
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n = valid.count()
    parts = max(1, min(-(-n // 1_024), max(4 * task_count(spark), -(-n // BUCKET_ROWS))))
    ordered = valid.withColumn("length", length).repartitionByRange(parts, F.col("length").desc(), "vec_id")
    buckets = _packed(ordered, BUCKET_ROWS, scale).withColumn("made", F.monotonically_increasing_id())
    buckets = cut_lineage(buckets)
    numbers = buckets.select("made", "longest")
    # One row per bucket (thousands of vectors each).
    numbers = numbers.withColumn("bucket", F.row_number().over(Window.orderBy(F.col("longest").desc(), "made")) - 1)
    buckets = cut_lineage(buckets.join(numbers.select("made", "bucket"), "made"))
    count = buckets.count()
    asked = valid.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = _query_blocks(asked, max(1, -(-n // (every * QUERY_ROWS))), scale)
    blocks = cut_lineage(blocks.select("block", *[F.col(c).alias(f"q_{c}") for c in _SIDE], F.col("longest").alias("q_longest")))

    first = blocks.withColumn("bucket", F.lit(0).cast("int")).withColumn("floor", F.lit(None).cast("binary"))
    seeds = cut_lineage(_search(first.join(buckets, "bucket"), k))
    floors = seeds.groupBy("query_id").agg(F.min("score").alias("at_least"), F.count(F.lit(1)).alias("found"))
    by_block = _with_floors(blocks, floors.where(F.col("found") >= k).select("query_id", "at_least"))
    # A query block goes to each bucket by number: an equi-join, and no bucket is ever sent anywhere twice.
    sent = by_block.where(F.lit(count) > 1).withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(max(1, count - 1)))))
    rest = _search(sent.join(buckets, "bucket").repartition(max(task_count(spark), 1), "block", "bucket"), k)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    every_row = seeds.unionByName(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return every_row.select("query_id", "rank", "vec_id", "score")


def _with_floors(blocks: DataFrame, floors: DataFrame) -> DataFrame:
    """Attach to each query block the scores its queries surely reach, in the block's order."""

    def ids_of(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["q_ids"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), row["block"])), pa.array(np.arange(len(ids))), pa.array(ids)],
                    names=["block", "place", "query_id"],
                )

    places = blocks.select("block", "q_ids").mapInArrow(ids_of, "block long, place long, query_id long")
    listed = (
        places.join(floors, "query_id", "left")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "at_least"))).alias("listed"))
    )

    def to_bytes(batches):
        for batch in batches:
            rows = batch.to_pylist()
            floor = [
                np.array([-np.inf if x["at_least"] is None else x["at_least"] for x in r["listed"]], float).tobytes() for r in rows
            ]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(floor, pa.binary())], names=["block", "floor"])

    return blocks.join(listed.mapInArrow(to_bytes, "block long, floor binary"), "block")
