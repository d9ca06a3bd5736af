"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``limit`` bits of each other agree in some part of the bits up to that
part's threshold whenever the thresholds, each plus one, add up to limit + 1.
Parts are groups of correlated bits (from the co-occurrence of all
fingerprints), so that the correlation inside a part does not weaken the
others; number of parts and thresholds come from a dynamic program over the candidates
that each threshold is expected to give, by the bits' frequencies in all fingerprints.

Every distinct fingerprint is sent to the keys (part, value) within the
threshold of each part, and sorted runs of a key are searched: short ones all
at once, long ones by walking from fingerprint to fingerprint over those not
reached yet, which touches a dense group once instead of in pairs. A run gives at most one
edge per member. Keys with more than ``HOT_RUN`` members are not gathered: their members
link through shared midpoints (fingerprints two bits away outside the part), a group-by
that is linear in the members and exact too.

Defined results: null text has no words and, like empty text, fingerprint zero. Equal
fingerprints are one node. Null ids take part like others (and never are the smallest id if
there is another). Rows that repeat get a row each. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomill.llm.common import task_count
from kinomill.llm.components import components
from kinomill.session import cut_lineage

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS = 64
LIMIT = 4
SHORT_RUN = 48
HOT_RUN = 20_000
SEED = 42


def fingerprint(text: bytes | None, size: int = 4) -> int:
    """Majority of the bits of the shingles' XXH64; 0 for texts without words."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - size] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp) of each row; fp as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


@dataclass(frozen=True)
class Plan:
    """Bits of each part and the part's threshold; -1 leaves the part out."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both (the diagonal: how many have the bit)."""

    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(values), 4096):
                bits = np.unpackbits(values[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                total += np.rint(bits.T.astype(np.float32) @ bits.astype(np.float32)).astype(np.int64)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "n"])

    sums = fps.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4,096 rows
    counts = np.zeros(BITS * BITS, np.int64)
    for row in sums:
        counts[row["at"]] = row["n"]
    return fps.count(), counts.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> tuple[tuple[int, ...], ...]:
    """Parts of equal width; each grows from its first free bit by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for i in range(parts):
        width = len(free) // (parts - i)
        left = sorted(free)
        strongest = max(left, key=lambda b: (max((correlation[b, c] for c in left if c != b), default=0.0), -b))
        part = [strongest]
        while len(part) < width:
            rest = [b for b in left if b not in part]
            part.append(max(rest, key=lambda b: (correlation[b, part].mean(), -b)))
        out.append(tuple(sorted(part)))
        free -= set(part)
    return tuple(out)


def _agreement(p: np.ndarray, part: tuple[int, ...], most: int) -> list[float]:
    """Chance that two fingerprints differ in at most 0, 1, ... bits of the part."""
    ways = np.zeros(most + 2)
    ways[0] = 1.0
    for b in part:
        differ = 2 * p[b] * (1 - p[b])
        ways = ways * (1 - differ) + np.concatenate([[0], ways[:-1]]) * differ
    return np.cumsum(ways)[: most + 1].tolist()


def _probes(width: int, threshold: int) -> int:
    return sum(comb(width, i) for i in range(threshold + 1))


def allocate(n: int, p: np.ndarray, parts: tuple[tuple[int, ...], ...], limit: int, probe_cost: float = 8.0) -> tuple[float, tuple[int, ...]]:
    """Least expected work per fingerprint and the thresholds for it: dynamic program over parts and the sum of thresholds plus one."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for part in parts:
        chance = _agreement(p, part, limit)
        grown: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, limit - used + 1):
                own = _probes(len(part), t) * probe_cost + n * chance[t] if t >= 0 else 0.0
                option = (cost + own, (*chosen, t))
                if used + t + 1 not in grown or option < grown[used + t + 1]:
                    grown[used + t + 1] = option
        best = grown
    return best[limit + 1]


def plan_for(fps: DataFrame, limit: int) -> Plan:
    n, both = bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    choices = []
    for count in range(2, 9):
        parts = group_bits(n, both, count)
        cost, thresholds = allocate(n, p, parts, limit)
        choices.append((cost, parts, thresholds))
    _, parts, thresholds = min(choices)
    return Plan(parts, thresholds)


def masks_within(bits: tuple[int, ...], most: int) -> np.ndarray:
    """All masks of up to ``most`` of the bits."""
    masks = [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(bits, k)]
    return np.array(masks, np.uint64)


def keys_of(values: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part number, key, fingerprint): the key is the part's bits, up to the threshold changed."""
    out = []
    for i, (part, threshold) in enumerate(zip(plan.parts, plan.thresholds)):
        if threshold >= 0:
            own = values & np.uint64(sum(1 << b for b in part))
            near = (own[:, None] ^ masks_within(part, threshold)[None, :]).ravel()
            out.append((np.full(len(near), i, np.int32), near, np.repeat(values, len(near) // max(1, len(values)))))
    return tuple(np.concatenate(x) for x in zip(*out))


def _keyed(fps: DataFrame, plan: Plan) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(values), 2048):
                if len(part := values[i : i + 2048]):
                    number, key, fp = keys_of(part, plan)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["part", "key", "fp"]
                    )

    return fps.mapInArrow(run, "part int, key long, fp long")


def link_run(values: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Edges that connect the members of a run just as all its links would: at most one per member."""
    left, edges = values, []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= limit
            if near.any():
                reached = left[near]
                edges += [(int(x), int(y)) for y in reached]
                frontier += list(reached)
                left = left[~near]
    return edges


def _short_runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """Linked pairs inside runs of at most SHORT_RUN members, by distance of places."""
    ends = np.repeat(starts + sizes, sizes)
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    found = []
    for step in range(1, int(sizes.max(initial=1))):
        keep = at + step < ends
        at, ends = at[keep], ends[keep]
        a, b = values[at], values[at + step]
        near = np.bitwise_count(a ^ b) <= limit
        found.append(np.stack([a[near], b[near]]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)


def _edges_of_sorted(limit: int):
    """Edges of sorted rows (part, key, fp); a run may go on in the next batch."""

    def emit(number, key, fp):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(key)))
        short = (sizes > 1) & (sizes <= SHORT_RUN)
        pairs = [_short_runs(fp, starts[short], sizes[short], limit)]
        for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
            linked = link_run(fp[start : start + size], limit)
            pairs.append(np.array(linked, np.uint64).reshape(-1, 2).T)
        u, v = np.concatenate(pairs, axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            if not len(now[0]):
                continue
            if held:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = int(last.argmax())
            if cut:
                yield emit(*(x[:cut] for x in now))
            held = [x[cut:] for x in now]
        if held:
            yield emit(*held)

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _hot_edges(hot: DataFrame, limit: int) -> DataFrame:
    """Links among members of hot keys by shared midpoints: two fingerprints differ in at most ``limit`` bits
    just if some third is within the halves of ``limit`` of them.

    Members of a key may differ inside the part (thresholds above 0), so midpoints are taken over all bits.
    """
    if limit % 2:
        raise ValueError("midpoints need an even limit")
    masks = [_signed(int(m)) for m in masks_within(tuple(range(BITS)), limit // 2)]
    # One midpoint table for all hot keys: a link across two of them is a link as well.
    members = hot.select("fp").distinct()
    midpoint = F.explode(F.transform(F.lit(masks), lambda m: m.bitwiseXOR(F.col("fp"))))
    spread = members.select("fp", midpoint.alias("mid"))
    least = spread.groupBy("mid").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return spread.join(least, "mid").where("fp <> least").select(F.greatest("fp", "least").alias("u"), F.least("fp", "least").alias("v")).distinct()


def links(fps: DataFrame, limit: int = LIMIT, hot_run: int = HOT_RUN) -> DataFrame:
    """Edges (u, v) among distinct fingerprints ``fps`` (fp) that connect all those linked within ``limit`` bits."""
    plan = plan_for(fps, limit)
    keyed = _keyed(fps, plan)
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    hot_keys = cut_lineage(sizes.where(F.col("n") > hot_run).select("part", "key"))
    cold = keyed
    found_hot = not hot_keys.isEmpty()
    if found_hot:
        cold = keyed.join(hot_keys, ["part", "key"], "left_anti")
    tasks = task_count(fps.sparkSession)
    ordered = cold.repartition(tasks, "part", "key").sortWithinPartitions("part", "key")
    edges = ordered.mapInArrow(_edges_of_sorted(limit), "u long, v long")
    if found_hot:
        edges = edges.unionByName(_hot_edges(keyed.join(hot_keys, ["part", "key"], "left_semi"), limit))
    return edges


def near_duplicates(docs: DataFrame, size: int = 4, limit: int = LIMIT, hot_run: int = HOT_RUN) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id among documents reachable over links, for each row."""
    marked = cut_lineage(fingerprints(docs, size))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), limit, hot_run)).withColumnsRenamed({"node": "fp"})
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut_lineage(placed.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
