"""Ranked lexical search: range-maximum tables per posting list, best-first document intervals.

The index is a table of segments. A segment is a run of documents of one task,
about ``SEGMENT_TERMS`` terms, ordered by id; it has one row per term, the posting
list, and one row for the documents' ids and lengths. Both are written by the same task, so they belong
together however often tasks are repeated. Segments can be added; terms and totals are counted over all of them.

A search joins the queries' terms with the posting lists, groups the lists by segment and block of queries, and searches each
segment on its own. A document's part of the score is its impact in a term's list; a sparse table over each list gives the
largest impact inside any interval of documents at once. Intervals are taken best first: the sum of the terms' largest
impacts bounds every document of an interval; the document at the maximum of the strongest term is scored, and splits its
interval in two, each with its own, smaller bound. Intervals below the k-th best score, or equal to it with larger ids only,
are left. Intervals of one document need no split, as their bound is the score.

A first, short search scores a few documents in each segment. The k-th best of them is a score that
k documents reach, so the second search, which is complete, starts from it in every segment.

Defined results: null text and text without terms match nothing and do not count as documents; null or repeated
ids are documents of their own, null after all others among equal scores. Rows of ``items`` with the same
id are one item with the terms of all of them; a null item id is an id like any other. Terms no document
holds add nothing. Empty tables give no rows. Integers are 64-bit: they hold while 50 times a document's terms
times the number of documents stays below 2^63.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinomill.session import cut_lineage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEGMENT_TERMS = 2_000_000
QUERY_BLOCK = 256
BROADCAST_TERMS = 500_000
FRONT = 512  # intervals split side by side
PROBE_SPLITS = 24  # per segment and item in the first search

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENTS = "segment long, term string, docs array<int>, tf array<int>, ids array<long>, n array<long>"


def terms(text: Column) -> Column:
    """Terms of a text in order; only A-Z are lower-cased. Null for null."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _segment(number: int, ids: pa.Array, lengths: np.ndarray, flat: pa.Array) -> pa.RecordBatch:
    """Posting lists of one segment; documents are numbered by id, those without an id last."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, tf = np.unique(codes * len(order) + np.repeat(place, lengths), return_counts=True)
    ends = np.append(0, np.searchsorted(pairs, np.arange(1, len(coded.dictionary) + 1) * len(order)))
    rows, none = len(coded.dictionary) + 1, pa.nulls
    docs = pa.concat_arrays([_lists(pairs % max(1, len(order)), ends, pa.int32()), none(1, pa.list_(pa.int32()))])
    counts = pa.concat_arrays([_lists(tf, ends, pa.int32()), none(1, pa.list_(pa.int32()))])
    whole = np.array([0, len(order)])
    own_ids = pa.ListArray.from_arrays(pa.array(whole, pa.int32()), ids.take(pa.array(order)))
    columns = [
        pa.array(np.full(rows, number), pa.int64()),
        pa.concat_arrays([coded.dictionary.cast(pa.string()), none(1, pa.string())]),
        docs,
        counts,
        pa.concat_arrays([none(rows - 1, pa.list_(pa.int64())), own_ids]),
        pa.concat_arrays([none(rows - 1, pa.list_(pa.int64())), _lists(lengths[order], whole, pa.int64())]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "term", "docs", "tf", "ids", "n"])


def _segments(size: int):
    def run(batches):
        first, made, held, count = TaskContext.get().partitionId() << 32, 0, [], 0

        def close():
            ids, lengths, flat = zip(*held)
            return _segment(first + made, pa.concat_arrays(ids), np.concatenate(lengths), pa.concat_arrays(flat))

        for batch in batches:
            batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column("terms")), 0), 0))
            lengths = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
            upto, at = np.cumsum(lengths), 0
            while at < batch.num_rows:
                done = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, done + size - count, side="right")))
                part = batch.slice(at, to - at)
                held.append((part.column("doc_id"), lengths[at:to], part.column("terms").flatten()))
                count += int(upto[to - 1]) - done
                at = to
                if count >= size or at < batch.num_rows:
                    yield close()
                    made, held, count = made + 1, [], 0
        if held:
            yield close()

    return run


class _Lists:
    """Posting lists of a segment that a block of queries needs, with their range-maximum tables.

    A cell of the table holds an impact and, below it, the place of its posting, the first of equal ones highest.
    """

    def __init__(self, docs: list[np.ndarray], tf: list[np.ndarray], weights: np.ndarray, m: np.ndarray):
        sizes = np.array([len(d) for d in docs], np.int64)
        self.ends = np.append(0, np.cumsum(sizes))
        self.docs, flat_tf = np.concatenate(docs).astype(np.int64), np.concatenate(tf).astype(np.int64)
        impact = np.repeat(weights, sizes) * ((1_000_000_000 * flat_tf) // (1000 * flat_tf + 20 * m[self.docs]))
        self.impact = impact
        # One rank of all impacts makes a cell (impact, place) one number.
        order = np.lexsort((-np.arange(len(impact)), impact))
        rank = np.empty(len(impact), np.int32)
        rank[order] = np.arange(len(impact), dtype=np.int32)
        self.place = order
        self.levels = [rank]
        while (1 << len(self.levels)) <= (sizes.max(initial=1)):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            above = below.copy()
            np.maximum(below[:-half], below[half:], out=above[:-half])
            self.levels.append(above)
        self.table = np.concatenate(self.levels)
        self.levels = None
        self.width = len(impact)
        # Ranks inside lists: bits of the documents a list holds, and how many come before each word of bits.
        words = (len(m) >> 6) + 1
        self.bits = np.zeros((len(sizes), words), np.uint64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        np.bitwise_or.at(self.bits, (row, self.docs >> 6), np.uint64(1) << (self.docs & 63).astype(np.uint64))
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(counts, axis=1) - counts

    def of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.bits[chosen], self.before[chosen], self.ends[chosen]

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Impact and place of the maximum in each range of places; 0 for empty ones."""
        size = high - low
        level = np.frexp(np.maximum(size, 1))[1].astype(np.int64) - 1
        base, some = level * self.width, size > 0
        a = self.table[np.where(some, base + low, 0)]
        b = self.table[np.where(some, base + high - (1 << level), 0)]
        place = self.place[np.maximum(a, b)]
        return np.where(some, self.impact[place], 0), place


def _better(score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Order of the k best: highest score, then first document."""
    return np.lexsort((doc, -score))[:k]


def search_segment(lists: _Lists, chosen: np.ndarray, n_docs: int, k: int, floor: int, splits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of a segment for the terms ``chosen`` with scores of ``floor`` or more: (documents, scores).

    With ``splits``, only that many intervals are split, and what was scored by then is returned.
    """
    bits, before, starts = lists.of(chosen)
    low, high = lists.ends[chosen][None, :], lists.ends[chosen + 1][None, :]
    begin, end = np.zeros(1, np.int64), np.full(1, n_docs, np.int64)
    value, place = lists.largest(low, high)
    bound, peak = value.sum(axis=1), place[np.arange(1), value.argmax(axis=1)]
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    terms_at = np.arange(len(chosen))[None, :]
    front, done = 1, 0
    while len(bound):
        take = np.argsort(-bound, kind="stable")[:front] if len(bound) > front else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[take] = False
        d = lists.docs[peak[take]]
        word, bit = (d >> 6)[:, None], (d & 63).astype(np.uint64)[:, None]
        cell = bits[terms_at, word]
        at = starts[None, :] + before[terms_at, word] + np.bitwise_count(cell & ((np.uint64(1) << bit) - np.uint64(1)))
        has = (cell >> bit & np.uint64(1)).astype(np.int64)
        exact = np.where(has > 0, lists.impact[np.minimum(at, lists.width - 1)], 0).sum(axis=1)
        done += len(take)
        # Left and right rest of each interval.
        new_low = np.concatenate([low[take], at + has])
        new_high = np.concatenate([at, high[take]])
        new_begin, new_end = np.concatenate([begin[take], d + 1]), np.concatenate([d, end[take]])
        some = new_begin < new_end
        new_low, new_high, new_begin, new_end = new_low[some], new_high[some], new_begin[some], new_end[some]
        value, place = lists.largest(new_low, new_high)
        new_bound, new_peak = value.sum(axis=1), place[np.arange(len(value)), value.argmax(axis=1)] if len(value) else np.zeros(0, np.int64)
        single = (new_end - new_begin == 1) & (new_bound > 0)
        docs = np.concatenate([docs, d, new_begin[single]])
        scores = np.concatenate([scores, exact, new_bound[single]])
        best = _better(scores, docs, k)
        docs, scores = docs[best], scores[best]
        least, last = (int(scores[-1]), int(docs[-1])) if len(scores) == k else (0, -1)

        def open_(b, s):
            return (b > 0) & (b >= floor) & ((b > least) | ((b == least) & (s < last)))

        old = rest & open_(bound, begin)
        new = ~single & open_(new_bound, new_begin)
        low, high = np.concatenate([low[old], new_low[new]]), np.concatenate([high[old], new_high[new]])
        begin, end = np.concatenate([begin[old], new_begin[new]]), np.concatenate([end[old], new_end[new]])
        bound, peak = np.concatenate([bound[old], new_bound[new]]), np.concatenate([peak[old], new_peak[new]])
        front = min(FRONT, 2 * front)
        if splits is not None and done >= splits:
            break
    keep = (scores > 0) & (scores >= floor)
    return docs[keep], scores[keep]


FOUND = "item_id long, doc_id long, score long"


def _search_group(k: int, splits: int | None, n_docs: int, n_terms: int):
    """Search of one segment for one block of queries, from its document row and the posting lists the block needs."""

    def run(table: pa.Table) -> pa.Table:
        schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
        own = pc.is_null(table.column("term"))
        head, lists = table.filter(own), table.filter(pc.invert(own))
        if not lists.num_rows:
            return schema.empty_table()
        ids = head.column("ids").combine_chunks().flatten()
        n = head.column("n").combine_chunks().flatten().to_numpy().astype(np.int64)
        m = 50 + (50 * n * n_docs) // n_terms
        docs = [np.asarray(x.values) for x in lists.column("docs")]
        tf = [np.asarray(x.values) for x in lists.column("tf")]
        index = _Lists(docs, tf, lists.column("w").to_numpy().astype(np.int64), m)
        wanted: dict = {}
        for at, items in enumerate(lists.column("items").to_pylist()):
            for x in items:
                wanted.setdefault((x["item_id"], x["floor"]), []).append(at)
        out = []
        for (item, floor), chosen in wanted.items():
            found, scores = search_segment(index, np.array(chosen), len(n), k, floor, splits)
            if len(found):
                same = pa.array([item] * len(found), pa.int64())
                out.append(pa.table([same, ids.take(pa.array(found)), pa.array(scores, pa.int64())], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item, ranked; Spark keeps k rows per item and task before the shuffle."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class LexicalIndex:
    """Segments below a folder; each ``add`` appends its own."""

    spark: SparkSession
    path: str

    def add(self, docs: DataFrame, segment_terms: int = SEGMENT_TERMS) -> None:
        """Append the documents (doc_id, text) as new segments."""
        rows = docs.select("doc_id", terms(F.col("text")).alias("terms"))
        made = rows.mapInArrow(_segments(segment_terms), SEGMENTS).withColumn("batch", F.lit(uuid.uuid4().hex))
        made.write.mode("append").parquet(self.path)

    def segments(self) -> DataFrame:
        """All rows; a segment's number is its own inside the ``batch`` that added it."""
        return self.spark.read.schema(f"{SEGMENTS}, batch string").parquet(self.path)

    def totals(self) -> tuple[int, int]:
        """Documents with a term, and terms."""
        own = self.segments().where("term is null")
        row = own.select(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
        return row[0] or 0, row[1] or 0

    def weights(self, wanted: DataFrame) -> DataFrame:
        """(term, w) of the distinct terms ``wanted`` that documents hold."""
        lists = self.segments().where("term is not null").select("term", F.size("docs").alias("held"))
        df = lists.join(wanted, "term").groupBy("term").agg(F.sum("held").alias("df"))
        n = self.totals()[0]
        return df.select("term", F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w"))

    def search(self, items: DataFrame, k: int) -> DataFrame:
        """(item_id, rank, doc_id, score): the k best documents for each item (item_id, text) with a score above 0."""
        asked = items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
        asked, many = _kept(asked)
        n_items = asked.select("item_id").distinct().count()
        blocks = max(1, -(-n_items // QUERY_BLOCK))
        n_docs, n_terms = self.totals()
        wanted = asked.select("term").distinct()
        weights, _ = _kept(self.weights(F.broadcast(wanted) if many <= BROADCAST_TERMS else wanted).where("w > 0"))

        def found(floors: DataFrame, splits: int | None) -> DataFrame:
            of = asked.join(floors, asked["item_id"].eqNullSafe(floors["f_item"]), "left")
            item = F.struct(asked["item_id"].alias("item_id"), F.coalesce("floor", F.lit(1)).alias("floor"))
            block = F.pmod(F.xxhash64(asked["item_id"]), F.lit(blocks).cast("long")).alias("block")
            queries = of.select("term", block, item.alias("item")).groupBy("term", "block").agg(F.collect_list("item").alias("items"))
            queries = queries.join(weights, "term")
            if many <= BROADCAST_TERMS:
                queries = F.broadcast(queries)
            rows = self.segments()
            lists = rows.where("term is not null").select("batch", "segment", "term", "docs", "tf").join(queries, "term")
            lists = lists.select("batch", "segment", "block", "term", "docs", "tf", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("n"), "w", "items")
            own = rows.where("term is null").select("batch", "segment", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "term", "docs", "tf", "ids", "n")
            own = own.withColumns({"w": F.lit(None).cast("long"), "items": F.lit(None).cast(lists.schema["items"].dataType)})
            groups = lists.unionByName(own).groupBy("batch", "segment", "block")
            return groups.applyInArrow(_search_group(k, splits, n_docs, max(1, n_terms)), FOUND)

        nothing = self.spark.createDataFrame([], "f_item long, floor long")
        probed = _best(found(nothing, PROBE_SPLITS), k).where(F.col("rank") == k)
        floors, _ = _kept(probed.select(F.col("item_id").alias("f_item"), F.col("score").alias("floor")))
        return _best(found(floors, None), k).select("item_id", "rank", "doc_id", "score")


def _kept(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once, and its rows."""
    held = cut_lineage(df)
    return held, held.count()
