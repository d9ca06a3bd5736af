"""Split documents into shards of nearly equal bytes: minimax contiguous partition, in DataFrame operations only.

Documents of equal text form one atomic group. Groups are ordered by a hash of
their text; shards are contiguous in that order. The smallest capacity with
which at most ``shards`` shards suffice is found by binary search, each try
checked by filling shards greedily, and the groups are cut where the greedy
filling with that capacity cuts. Groups that set the capacity are set apart and the
others cut anew with a capacity of their own; no shard is empty if there are groups enough.

The search never sees single groups unless it must. It starts from sums over
4,096 ranges of the hash. Taking each range as one piece gives a capacity that
surely suffices, taking it as freely divisible one that is surely needed; only
ranges in which a cut may fall between the two are summed again, 4,096 times
finer, until both capacities agree. What comes to the driver is at most 4,096
sums per range that may hold a cut, whatever the size of the data.

Defined results: null text has no bytes and counts as equal to empty text;
repeated ids are numbered like other rows; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinomill.session import cut_lineage

KEY_BITS, STEP_BITS = 60, 12
ROWS_PER_BLOCK = 20_000


@dataclass(frozen=True)
class Range:
    """Groups with keys from ``first`` to ``last``; ``shift`` low bits of the key are not told apart yet."""

    first: int
    last: int
    size: int
    shift: int

    @property
    def atomic(self) -> bool:
        return self.first == self.last


def _range_sums(groups: DataFrame, shift: int, within: list[Range]) -> list[Range]:
    """Sums by the key bits above ``shift``, of all groups or those of the given ranges."""
    rows = groups
    if within:
        wide = shift + STEP_BITS
        rows = rows.where(F.shiftright("key", wide).isin([r.first >> wide for r in within]))
    sums = rows.groupBy(F.shiftright("key", shift).alias("at")).agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.sum("size").alias("size")
    )
    return sorted((Range(r["first"], r["last"], r["size"], shift) for r in sums.collect()), key=lambda r: r.first)


def _step(ends: list[int], sizes: list[int], solid: list[bool], alone: list[int], done: int, capacity: int) -> int:
    """Sum before the end of the shard that begins at ``done`` and is filled to ``capacity``.

    ``ends`` are running sums. A range that is not ``solid`` may be cut anywhere; those at the rising places ``alone`` are a shard each.
    """
    here = bisect_right(ends, done)
    k = bisect_left(alone, here)
    if k < len(alone) and alone[k] == here:
        return ends[here]
    stop = ends[alone[k]] - sizes[alone[k]] if k < len(alone) else ends[-1]
    reach = done + capacity
    if reach >= stop:
        return stop
    at = bisect_right(ends, reach)
    whole = ends[at - 1] if at else 0
    return max(whole, done) if solid[at] else reach


def _greedy(ends, sizes, solid, alone, capacity: int, shards: int) -> list[int] | None:
    """Sum before each shard's end when shards are filled to ``capacity``; None if more shards are needed."""
    cuts, done, total = [], 0, ends[-1] if ends else 0
    while done < total and len(cuts) < shards:
        step = _step(ends, sizes, solid, alone, done, capacity)
        if step <= done:
            return None  # the next group alone is larger than the capacity
        done = step
        cuts.append(done)
    return cuts if done >= total else None


def _smallest(ends, sizes, solid, alone, shards) -> int:
    low, high = 0, (ends[-1] if ends else 0)
    while low < high:
        middle = (low + high) // 2
        if _greedy(ends, sizes, solid, alone, middle, shards) is not None:
            high = middle
        else:
            low = middle + 1
    return low


def _reach(ends, sizes, solid, alone, capacity, shards) -> list[int]:
    """Like _greedy, but goes on for ``shards`` cuts even if the rest does not fit."""
    cuts, done, total = [], 0, ends[-1]
    for _ in range(shards):
        done = total if done >= total else _step(ends, sizes, solid, alone, done, capacity)
        cuts.append(done)
    return cuts


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and the first key of each shard but the first; ``groups`` has key and size, one row per key.

    A group as large as the capacity is a shard of its own in every partition that respects it. It is
    set apart and the search goes on for the others with the shards left, until no single group sets the capacity.
    """
    shift = KEY_BITS - STEP_BITS
    ranges = _range_sums(groups, shift, [])
    if not ranges:
        return 0, []
    apart: set[int] = set()
    most = None
    while True:
        sizes = [r.size for r in ranges]
        ends, run = [], 0
        for size in sizes:
            run += size
            ends.append(run)
        pieces, atoms = [True] * len(ranges), [r.atomic for r in ranges]
        alone = [i for i, r in enumerate(ranges) if r.atomic and r.first in apart]
        enough = _smallest(ends, sizes, pieces, alone, shards)
        needed = _smallest(ends, sizes, atoms, alone, shards)
        early, late = _reach(ends, sizes, pieces, alone, needed, shards), _reach(ends, sizes, atoms, alone, enough, shards)
        open_ranges = [
            r
            for r, end in zip(ranges, ends)
            if not r.atomic and any(a < end and b > end - r.size for a, b in zip(early, late))
        ]
        if enough == needed or not open_ranges:
            most = enough if most is None else most
            full = {r.first for r in ranges if r.atomic and r.size == enough} - apart
            if not full:
                break
            apart |= full
            continue
        # All open ranges of the coarsest level at once; finer ones follow in the next rounds.
        coarse = max(r.shift for r in open_ranges)
        split = [r for r in open_ranges if r.shift == coarse]
        finer = _range_sums(groups, coarse - STEP_BITS, split)
        gone = {r.first for r in split}
        ranges = sorted([r for r in ranges if r.first not in gone] + finer, key=lambda r: r.first)
    cuts = _greedy(ends, sizes, pieces, alone, enough, shards)
    firsts = []
    for done in cuts[:-1]:
        at = bisect_right(ends, done)
        firsts.append(ranges[at].first)
    return most, firsts


def _shard_of(firsts: list[int]):
    shard = F.lit(0)
    for first in firsts:
        shard = shard + (F.col("key") >= first).cast("int")
    return shard


def balanced_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """As ``minimax_cuts``; while shards are empty, the largest one of several groups is cut in two as evenly as can be."""
    capacity, firsts = minimax_cuts(groups, shards)
    while len(firsts) + 1 < shards:
        loads = groups.groupBy(_shard_of(firsts).alias("shard")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        open_ = loads.where("n > 1").orderBy(F.desc("size"), "shard").limit(1).collect()
        if not open_:
            break
        _, cut = minimax_cuts(groups.where(_shard_of(firsts) == open_[0]["shard"]), 2)
        firsts = sorted(firsts + cut)
    return capacity, firsts


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document.

    Slots count from 0 without gaps inside a shard. Rows are numbered in blocks
    dealt by a hash of the id, so neither a hot text nor a whole shard is one
    task; a block's first slot is the number of rows in the blocks before it.
    """
    text = F.coalesce("text", F.lit(""))
    # Equal texts have equal keys. Different texts that share a key share a shard, which does no harm.
    key = F.xxhash64(text).bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    rows = cut_lineage(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("key")
        )
    )
    groups = cut_lineage(rows.groupBy("key").agg(F.sum("size").alias("size")))
    _, firsts = balanced_cuts(groups, shards)
    shard = _shard_of(firsts)
    blocks = max(256, rows.count() // ROWS_PER_BLOCK)
    dealt = rows.withColumn("shard", shard).withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(blocks)))
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    numbered = dealt.withColumn(
        "number", F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "key"))
    )
    return numbered.join(starts, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).cast("long").alias("slot")
    )
