"""Remove passages of ``window`` words that occurred before, with prefix-partitioned suffix trees.

The suffixes that go into trees start at anchors: of the ``window - prefix + 1`` prefixes of
``prefix`` words in a window, the one with the least hash (the leftmost of equal ones).
Equal windows have the same anchor, so a window belongs to exactly one
suffix, and a suffix is needed only if its prefix occurs again: prefixes are
counted first, and the suffixes of single ones are dropped.

Groups are made by prefixes of variable length. A prefix shared by at most
``GROUP_LEAVES`` suffixes is a group that fits in memory. Its subtree is built from the
sorted suffixes and the lengths of their common prefixes; the windows that start
j words before the anchor repeat at the inner nodes of depth ``window - j`` whose leaves
also agree in the j words to the left. A prefix shared by more is lengthened to
the full window, where a group is a single deep node of which only the
first place matters: a minimum with partial sums, so that a passage in a third of
all documents is gathered nowhere. There, each document sends its first place of a window only; places after
it in the same document repeat it whatever the others hold, and travel as runs.

Defined results: null text has no words; texts with fewer words than the window lose
nothing. Earlier means a smaller id, or the same id and an earlier start; a null id comes
after all others. Rows that repeat id and text get equal results; rows that
share only the id count as one document. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomill.llm.common import task_count
from kinomill.llm.hashing import finish, prefix_sums, span_hashes, word_hashes
from kinomill.session import cut_lineage

GROUP_LEAVES = 20_000
SALTS = 32
BYTES_PER_PASS = 2_000_000
LAST = (1 << 63) - 1


def anchors_of(hashes: np.ndarray, counts: np.ndarray, window: int, prefix: int):
    """(text number, place, first and last window start, prefix hash) of each anchor; places count words from the text's start."""
    spread = window - prefix + 1
    total = len(hashes)
    begins = np.cumsum(counts) - counts
    if total < window:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    places = np.arange(total - prefix + 1)
    grams = span_hashes(prefix_sums(hashes), places, places + prefix)
    # Least of each stretch of grams with its place, by doubling; of equal ones the left wins.
    best, at, width = grams, places, 1
    while width < spread:
        step = min(width, spread - width)
        a, b = best[:-step], best[step:]
        right = b < a
        best, at, width = np.where(right, b, a), np.where(right, at[step:], at[:-step]), width + step
    windows = np.maximum(0, counts - window + 1)
    text = np.repeat(np.arange(len(counts)), windows)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    chosen = at[begins[text] + starts]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(chosen)) - 1 if len(first) else first
    return text[first], chosen[first] - begins[text[first]], starts[first], starts[last], grams[chosen[first]]


def _passes(column, rows: int):
    """Slices of a batch of about BYTES_PER_PASS bytes."""
    sizes = np.array([len(x.as_py() or b"") for x in column], np.int64)
    upto, at = np.cumsum(sizes), 0
    while at < rows:
        n = max(1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BYTES_PER_PASS)) - at)
        yield at, min(n, rows - at)
        at += n


def _anchors(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """(gram, row, place) of every anchor."""

    def run(batches):
        for batch in batches:
            for at, n in _passes(batch.column("text"), batch.num_rows):
                part = batch.slice(at, n)
                hashes, counts = word_hashes([x or b"" for x in part.column("text").to_pylist()])
                text, place, _, _, gram = anchors_of(hashes, counts, window, prefix)
                rows = part.column("row").to_numpy()[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(rows), pa.array(place.astype(np.int32))], names=["gram", "row", "place"]
                )

    return docs.select("row", "text").mapInArrow(run, "gram long, row long, place int")


def _texts(batch):
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in batch.column("packed").to_pylist()]


def _wanted_anchors(batch, window, prefix):
    """Words of each text, and the anchors whose places are in the column ``places``."""
    texts = _texts(batch)
    hashes, counts = word_hashes(texts)
    text, place, low, high, gram = anchors_of(hashes, counts, window, prefix)
    wanted = batch.column("places")
    owner = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
    keep = np.isin((text << 32) | place, (owner << 32) | wanted.flatten().to_numpy().astype(np.int64))
    return [t.split() for t in texts], [x[keep] for x in (text, place, low, high, gram)]


def _leaves(joined: DataFrame, window: int, prefix: int) -> DataFrame:
    """Suffixes with the words around their prefix that their windows reach."""
    schema = "gram long, doc_id long, row long, place int, low int, high int, before binary, after binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words, (text, place, low, high, gram) = _wanted_anchors(part, window, prefix)
                before, after = [], []
                for t, p, a, b in zip(text.tolist(), place.tolist(), low.tolist(), high.tolist()):
                    before.append(b" ".join(words[t][a:p]))
                    after.append(b" ".join(words[t][p + prefix : b + window]))
                ids, rows = (part.column(c).to_numpy()[text] for c in ("doc_id", "row"))
                columns = [gram.view(np.int64), ids, rows, *(x.astype(np.int32) for x in (place, low, high))]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=names
                )

    return joined.mapInArrow(run, schema)


def _full_windows(joined: DataFrame, window: int, prefix: int) -> DataFrame:
    """Windows of the given anchors: the first of each content in a document, with a 128-bit hash of its words,
    and runs of ``times`` windows (without hash) that repeat an earlier one of their document."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words, (text, _, low, high, _) = _wanted_anchors(part, window, prefix)
                hashes, counts = word_hashes([b" ".join(w) for w in words])
                begins = np.cumsum(counts) - counts
                times = high - low + 1
                text = np.repeat(text, times)
                start = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
                here = begins[text] + start
                one = span_hashes(prefix_sums(hashes), here, here + window)
                two = span_hashes(prefix_sums(finish(hashes)), here, here + window)
                # Windows come in the order of their text and start.
                _, first = np.unique(finish(finish(one ^ text.astype(np.uint64)) ^ two), return_index=True)
                again = np.ones(len(start), bool)
                again[first] = False
                at_again = np.flatnonzero(again)
                breaks = (np.diff(text[at_again]) != 0) | (np.diff(start[at_again]) != 1)
                begin = at_again[np.concatenate([[True], breaks])] if len(at_again) else at_again
                times = np.diff(np.append(np.searchsorted(at_again, begin), len(at_again)))
                first = np.sort(first)
                for chosen, n, hashed in ((first, np.ones(len(first), np.int64), True), (begin, times, False)):
                    ids, rows = (part.column(c).to_numpy()[text[chosen]] for c in ("doc_id", "row"))
                    keys = [pa.array(x[chosen].view(np.int64)) if hashed else pa.nulls(len(chosen), pa.int64()) for x in (one, two)]
                    numbers = [ids, rows, start[chosen].astype(np.int32), n.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays(
                        [*keys, *map(pa.array, numbers)], names=["one", "two", "doc_id", "row", "start", "times"]
                    )

    return joined.mapInArrow(run, "one long, two long, doc_id long, row long, start int, times int")


def _filled(texts: list[bytes], width: int, backward: bool) -> np.ndarray:
    """Word hashes of short texts as rows of a table, nearest to the prefix first; 0 where there is no word."""
    hashes, counts = word_hashes(texts)
    out = np.zeros((len(texts), width), np.uint64)
    row = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    if backward:
        place = counts[row] - 1 - place
    out[row, place] = hashes | np.uint64(1)
    return out


def subtree_repeats(gram, doc_id, place, low, high, before, after, window: int, prefix: int) -> np.ndarray:
    """Bit j of a leaf: its window that starts j words before the prefix occurs at an earlier place of the group."""
    spread = window - prefix
    right, left = _filled(after, spread, False), _filled(before, spread, True)
    order = np.lexsort((*right.T[::-1], gram))
    gram, doc_id, place, low, high = (x[order] for x in (gram, doc_id, place, low, high))
    right, left = right[order], left[order]
    common = np.cumprod(right[1:] == right[:-1], axis=1).sum(1)
    same = gram[1:] == gram[:-1]
    flags = np.zeros(len(gram), np.int32)
    by_place = np.lexsort((place, doc_id))
    to_left = np.zeros(len(gram), np.uint64)
    for j in range(spread + 1):
        if j:
            to_left = finish(to_left * np.uint64(3) + left[:, j - 1])
        own = (place - j >= low) & (place - j <= high)
        # Inner nodes of depth window - j: runs of leaves that share the rest of the window.
        node = np.concatenate([[0], np.cumsum(~(same & (common >= spread - j)))]).astype(np.uint64)
        leaf = by_place[own[by_place]]
        if not len(leaf):
            continue
        repeat = finish(finish(node) ^ to_left)[leaf]
        _, first, group = np.unique(repeat, return_index=True, return_inverse=True)
        first = leaf[first][group]
        later = (doc_id[leaf] > doc_id[first]) | ((doc_id[leaf] == doc_id[first]) & (place[leaf] > place[first]))
        flags[leaf[later]] |= 1 << j
    out = np.empty(len(gram), np.int32)
    out[order] = flags
    return out


def _subtrees(window: int, prefix: int):
    """Flags of sorted leaves; a group may go on in the next batch."""
    names = ["row", "place", "flags"]

    def emit(table: pa.Table):
        column = {c: table.column(c).to_numpy() for c in ("gram", "doc_id", "row", "place", "low", "high")}
        flags = subtree_repeats(
            column["gram"], column["doc_id"], column["place"], column["low"], column["high"],
            table.column("before").to_pylist(), table.column("after").to_pylist(), window, prefix,
        )
        hit = flags != 0
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (column["row"], column["place"], flags)], names=names)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if held is not None else now
            gram = now.column("gram").to_numpy()
            cut = int(np.argmax(gram == gram[-1]))
            if cut:
                yield emit(now.slice(0, cut))
            held = now.slice(cut)
        if held is not None:
            yield emit(held)

    return run


def _kept(joined: DataFrame, window: int) -> DataFrame:
    """Cover the flagged windows and join what is left."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, flags in zip(_texts(batch), batch.column("found").to_pylist()):
                words = text.split()
                n_words.append(len(words))
                if flags:
                    place, bits, times = np.array([(f["place"], f["flags"], f["times"]) for f in flags], np.int64).T
                    change = np.zeros(len(words) + 1, np.int64)
                    for j in range(int(bits.max()).bit_length()):
                        chosen = (bits >> j) & 1 == 1
                        start = place[chosen] - j
                        np.add.at(change, start, 1)
                        np.add.at(change, start + times[chosen] - 1 + window, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    words = list(compress(words, stays.tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_removed)), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    columns = joined.select("doc_id", "packed", "found")
    return columns.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def _packed(docs: DataFrame) -> DataFrame:
    """Documents with their texts in zstd frames, for the shuffle."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(x.as_py() or b"") for x in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), packed], names=["doc_id", "row", "packed"])

    return docs.mapInArrow(run, "doc_id long, row long, packed binary")


def remove_repeats(docs: DataFrame, window: int = 20, prefix: int = 8, group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of each row of ``docs`` (doc_id, text)."""
    # A row is known by a hash of id and text: rows that repeat both are alike in all that follows.
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    anchors = _anchors(rows, window, prefix)
    repeated = cut_lineage(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    any_hot = not repeated.where(F.col("n") > group_leaves).isEmpty()
    met = anchors.join(repeated, "gram").select("row", "place", (F.col("n") > group_leaves).alias("hot"))
    places = [F.collect_set(F.when(F.col("hot") == hot, F.col("place"))).alias(name) for name, hot in (("cold", False), ("hot", True))]
    wanted = cut_lineage(met.groupBy("row").agg(*places))
    # One shuffle of the texts serves the search and the result. An inner join adds this filter of its own below the
    # shuffle; with it on both sides Spark sees that they are the same.
    dealt = _packed(rows).where("row is not null").repartition("row")
    tasks = task_count(docs.sparkSession)

    def placed(name: str) -> DataFrame:
        joined = dealt.join(wanted.where(F.size(name) > 0).select("row", F.col(name).alias("places")), "row")
        return joined.select("row", F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "packed", "places")

    leaves = _leaves(placed("cold"), window, prefix).repartition(tasks, "gram").sortWithinPartitions("gram")
    found = leaves.mapInArrow(_subtrees(window, prefix), "row long, place int, flags int").withColumn("times", F.lit(1))
    if any_hot:
        deep = _full_windows(placed("hot"), window, prefix)
        hashed = deep.where("one is not null")
        # One row per window; sent once per salt, so that the documents of a hot window are dealt out.
        first = hashed.groupBy("one", "two").agg(F.min(F.struct("doc_id", "start")).alias("first"))
        first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = hashed.withColumn("salt", F.pmod(F.hash("row"), F.lit(SALTS)))
        later = salted.join(first, ["one", "two", "salt"]).where(F.struct("doc_id", "start") > F.col("first"))
        again = later.select("row", "start", "times").unionByName(deep.where("one is null").select("row", "start", "times"))
        found = found.unionByName(again.select("row", F.col("start").alias("place"), F.lit(1).alias("flags"), "times"))
    by_row = found.groupBy("row").agg(F.collect_list(F.struct("place", "flags", "times")).alias("found"))
    return _kept(dealt.join(by_row, "row", "left"), window)
