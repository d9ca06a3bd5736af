"""SimHash near-dedup: documents whose fingerprints are close, confirmed by the Jaccard similarity of their word shingles.

Two texts are linked if their sets of five-word shingles have a similarity of at
least 0.8; near copies are the connected components. Candidates come from SimHash fingerprints of these sets, by the
pigeonhole keys of ``simhash`` for 4 or fewer differing bits. What is proposed counts only if the whole sets say so, in integers.

At similarity 0.8 fingerprints differ in ten bits on average and in up to ``BITS_APART``; pigeonhole keys for so many bits
are met by a fixed share of all other documents, so their work grows with the square of the corpus. The links that lie
beyond 4 bits are therefore completed from a second source:
members are brought together by MinHash buckets, ``BANDS`` of ``ROWS`` minima each, which miss a pair of
similarity 0.8 with chance (1 - 0.8^6)^50 < 3e-7, and the fingerprint that travels with each member
decides inside a bucket.

A bucket is a run of sorted rows, walked from member to member over those not reached yet: at most one candidate per
member, never all pairs. Runs of more than ``RUN_ROWS`` members are dealt into several, each with the same leaders, another choice in
each bucket. Of its candidates a member first has only the nearest one verified; those that lie in its
component by then are dropped unseen; of the others the next eight are verified, then the rest. Then runs whose members are
still apart are walked once more, towards the nearest members of other components.

These walks leave out members whose fingerprints differ in more bits, those in other parts of a large run, and all but one or a few others of a
member. What is still in different components is therefore closed without any such choice: the members of each bucket with several
components meet with their whole sets, and all outside its largest component are compared with all members of other ones.
Pairs are decided where they meet, and a bucket gives at most one link for each two components it joins. Buckets of more than ``BLOCK`` shingles
meet in blocks, each part with each group of those outside. After that no two members of a bucket have a link and different components.

Defined results: words are as in ``simhash``; a text of fewer than ``size`` words is
one shingle; null and texts without words are copies of each other. Null ids take part
like others (and never are the smallest id if there is another). Rows that repeat get a row each. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinomill.llm import simhash
from kinomill.llm.common import task_count
from kinomill.llm.components import FEW, components
from kinomill.llm.hashing import finish, gather, prefix_sums, span_hashes, word_hashes
from kinomill.llm.simhash import LOWER
from kinomill.session import cut_lineage

SIZE = 5
ROWS, BANDS = 6, 50
BYTES_PER_PASS = 4_000_000
BITS_APART = 20
RUN_ROWS = 20_000
BLOCK = 2_000_000
NEAREST = 4
_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32) | np.uint32(1)
_MIX = _RNG.integers(0, 1 << 63, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    words, counts = word_hashes([t.translate(LOWER) for t in texts])
    sums, first = prefix_sums(words), np.cumsum(counts) - counts
    many = np.where(counts > size, counts - size + 1, np.minimum(counts, 1))
    start = gather(first, many)
    hashes = span_hashes(sums, start, start + np.repeat(np.minimum(counts, size), many))
    ends = np.cumsum(many)
    return [np.unique(hashes[e - n : e]) for e, n in zip(ends.tolist(), many.tolist())]


def bucket_keys(shingles: np.ndarray) -> np.ndarray:
    """One key per band, from the minima of its hash functions; none for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    x, least = (shingles >> np.uint64(32)).astype(np.uint32), np.full(ROWS * BANDS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (_FACTORS[:, None] * x[None, i : i + 1024]).min(axis=1), out=least)
    return finish((least.reshape(BANDS, ROWS).astype(np.uint64) * _MIX[:, :ROWS]).sum(axis=1, dtype=np.uint64) + _MIX[:, ROWS])


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def _passes(column: pa.Array):
    """Texts of a batch in slices of bounded bytes: (first row, texts)."""
    texts, at, held = [], 0, 0
    for i, t in enumerate(column):
        texts.append(t.as_py() or b"")
        held += len(texts[-1])
        if held >= BYTES_PER_PASS:
            yield at, texts
            texts, at, held = [], i + 1, 0
    if texts:
        yield at, texts


def _signed(numbers) -> pa.Array:
    return pa.array(np.array(numbers, np.uint64).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), _signed(np.concatenate(arrays)))


def _binary(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def majority(hashes: np.ndarray) -> int:
    """SimHash: each bit that is set in over half of the hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little").view(np.uint64)[0])


def signatures(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, text_hash, node, n, fp, keys) of each row: hash, number and SimHash of its shingles, and its buckets."""

    def run(batches):
        for batch in batches:
            for at, texts in _passes(batch.column("text")):
                sets = shingle_sets(texts, size)
                columns = [batch.column(c).slice(at, len(sets)) for c in ("doc_id", "text_hash")]
                columns += [_signed([_node(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64())]
                columns += [_signed([majority(s) for s in sets]), _lists([bucket_keys(s) for s in sets])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "n", "fp", "keys"])

    whole = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, n bigint, fp bigint, keys array<bigint>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of each row."""

    def run(batches):
        for batch in batches:
            for _, texts in _passes(batch.column("text")):
                sets = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays([_signed([_node(s) for s in sets]), _lists(sets)], names=["node", "shingles"])

    return _binary(docs).mapInArrow(run, "node bigint, shingles array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of similarity 0.8 or more: 5 |both| >= 4 |either|."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return pairs.join(left, "u").join(right, "v").where(9 * both >= 4 * (F.size("su") + F.size("sv"))).select("u", "v")


def _alike(n: np.ndarray, fp: np.ndarray, at: int) -> np.ndarray:
    """Members whose size and fingerprint allow a link with the one at ``at``."""
    close = np.bitwise_count(fp ^ fp[at]) <= BITS_APART
    return close & (5 * np.minimum(n, n[at]) >= 4 * np.maximum(n, n[at]))


def walk_run(node: np.ndarray, n: np.ndarray, fp: np.ndarray, root: np.ndarray) -> list[np.ndarray]:
    """(member, other, bits apart): each member from the one that reached it first."""
    left, found = np.arange(len(node)), []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            here = np.append(left, x)
            near = _alike(n[here], fp[here], len(left))[:-1]
            reached, left = left[near], left[~near]
            if len(reached):
                found.append(np.stack([node[reached], np.repeat(node[x], len(reached)), np.bitwise_count(fp[reached] ^ fp[x]).astype(np.int64)]))
                frontier += list(reached)
    return found


def walk_apart(node: np.ndarray, n: np.ndarray, fp: np.ndarray, root: np.ndarray) -> list[np.ndarray]:
    """(member, other, bits apart): for members outside the run's largest component, the nearest of up to ``NEAREST`` others."""
    roots, place, counts = np.unique(root, return_inverse=True, return_counts=True)
    found = []
    if len(roots) < 2:
        return found
    for x in np.flatnonzero(place != counts.argmax()):
        here = np.flatnonzero(_alike(n, fp, x) & (place != place[x]))
        apart = np.bitwise_count(fp[here] ^ fp[x]).astype(np.int64)
        order = np.argsort(apart, kind="stable")
        _, first = np.unique(place[here[order]], return_index=True)
        for y in order[np.sort(first)[:NEAREST]]:
            found.append(np.array([[node[x]], [node[here[y]]], [apart[y]]]))
    return found


def _walked(walk):
    """``walk`` over the runs of rows sorted by (key, part); a run may go on in the next batch."""

    def emit(key, part, node, n, fp, root):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        found = [np.zeros((3, 0), np.int64)]
        for a, b in zip(starts, np.append(starts[1:], len(key))):
            if b - a > 1:
                found += walk(node[a:b], n[a:b], fp[a:b].view(np.uint64), root[a:b])
        u, v, apart = np.concatenate(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(apart)], names=["u", "v", "apart"])

    def run(batches):
        held = None
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if not len(now[0]):
                continue
            if held:
                now = [np.concatenate(x) for x in zip(held, now)]
            cut = int(((now[0] == now[0][-1]) & (now[1] == now[1][-1])).argmax())
            if cut:
                yield emit(*(x[:cut] for x in now))
            held = [x[cut:] for x in now]
        if held:
            yield emit(*held)

    return run


def _members(nodes: DataFrame, run_rows: int) -> DataFrame:
    """Members (key, parts, part, node, n, fp) of buckets of at least two; large buckets in parts."""
    rows = nodes.select(F.explode("keys").alias("key"), "node", "n", "fp")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = rows.join(sizes.select("key", F.ceil(F.col("rows") / run_rows).alias("parts")), "key")
    return met.withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")))


def _runs(met: DataFrame) -> DataFrame:
    """Rows (key, part, node, n, fp) of the runs; the parts of a large bucket share its leaders."""
    # The mask makes others the leaders in each bucket; they join the parts that are not their own.
    masked = F.struct(F.col("node").bitwiseXOR(F.xxhash64("key")).alias("masked"), "node", "n", "fp", "part")
    large = met.where("parts > 1").groupBy("key", "parts").agg(F.min(masked).alias("low"), F.max(masked).alias("high"))
    large = large.select("key", F.explode(F.array("low", "high")).alias("l"), "parts")
    spread = large.select("key", "l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).where("part <> l.part")
    return met.select("key", "part", "node", "n", "fp").unionByName(spread.select("key", "part", "l.node", "l.n", "l.fp"))


def _candidates(runs: DataFrame, roots: DataFrame | None, walk) -> DataFrame:
    """(u, v, apart): candidates from all runs, once each."""
    if roots is None:
        placed = runs.withColumn("root", F.col("node"))
    else:
        placed = runs.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = placed.select("key", "part", "node", "n", "fp", "root")
    # Another order in each bucket, so that a member is reached from different ones; the same in each repetition.
    order = ("key", "part", F.xxhash64("node", "key"))
    ordered = placed.repartition(task_count(runs.sparkSession), "key", "part").sortWithinPartitions(*order)
    return ordered.mapInArrow(_walked(walk), "u bigint, v bigint, apart bigint").distinct()


TAKES = (1, 8, 1 << 40)  # candidates of a member verified in each round; the last one takes the rest, at most one per bucket and walk


def _joined(roots: DataFrame | None, fresh: DataFrame, n: int) -> DataFrame:
    """Components (node, root) after ``n`` verified edges between nodes of different ones came in: only their roots are linked anew.

    Few rows are cheaper to link once more, in one partition, than to join.
    """
    if roots is None:
        return components(fresh)
    if n + roots.count() <= FEW:
        return components(roots.selectExpr("node as u", "root as v").unionByName(fresh).coalesce(1))
    of = roots.selectExpr("node as n", "root as r")
    ends = fresh.join(of, fresh["u"] == of["n"], "left").select(F.coalesce("r", "u").alias("u"), "v")
    ends = ends.join(of, ends["v"] == of["n"], "left").select("u", F.coalesce("r", "v").alias("v"))
    ends = cut_lineage(ends)
    moved = components(ends).selectExpr("node as old", "root as new")
    named = roots.join(moved, roots["root"] == moved["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = moved.join(roots, moved["old"] == roots["node"], "left_anti").selectExpr("old as node", "new as root")
    return cut_lineage(named.unionByName(alone))


def _settle(waiting: DataFrame, roots: DataFrame | None, sets: DataFrame) -> tuple[DataFrame | None, int]:
    """Verify candidates, nearest first, until each one is verified or lies inside a component: (components, edges found)."""
    found = 0
    nearest = Window.partitionBy("u").orderBy("apart", "v")
    for take in TAKES:
        if roots is not None:
            of_u, of_v = roots.selectExpr("node as u", "root as ru"), roots.selectExpr("node as v", "root as rv")
            apart = waiting.join(of_u, "u", "left").join(of_v, "v", "left")
            waiting = apart.where("coalesce(ru, u) <> coalesce(rv, v)").select("u", "v", "apart")
        ranked = cut_lineage(waiting.withColumn("nth", F.row_number().over(nearest)))
        if ranked.isEmpty():
            break
        fresh = cut_lineage(_verified(ranked.where(F.col("nth") <= take).select("u", "v"), sets))
        waiting = ranked.where(F.col("nth") > take).select("u", "v", "apart")
        n = fresh.count()
        if n:
            found, roots = found + n, _joined(roots, fresh, n)
    return roots, found


def link_members(node: np.ndarray, n: np.ndarray, root: np.ndarray, role: np.ndarray, shingles: np.ndarray) -> list[tuple[int, int]]:
    """Links (u, v) that join just those components which links between the members of a block join; ``shingles`` has all sets, one after the other.

    Members of odd roles are compared with those of role 0 and the smaller ones of roles 1 and 2.
    """
    _, token, counts = np.unique(shingles, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(node)), n)
    shared = counts[token] > 1
    token, owner = token[shared], owner[shared]
    first = np.cumsum(np.bincount(owner, minlength=len(node) + 1)) - np.bincount(owner, minlength=len(node) + 1)
    holders = owner[np.argsort(token, kind="stable")]
    many = np.bincount(token, minlength=len(counts))
    start = np.cumsum(many) - many
    place, found = np.unique(root, return_inverse=True)[1], []
    for x in np.flatnonzero(role % 2):
        open_ = (place != place[x]) & (5 * np.minimum(n, n[x]) >= 4 * np.maximum(n, n[x])) & ((role == 0) | ((role < 3) & (node < node[x])))
        if not open_.any():
            continue
        own = token[first[x] : first[x + 1]]
        both = np.bincount(holders[gather(start[own], many[own])], minlength=len(node))
        linked = np.flatnonzero(open_ & (9 * both >= 4 * (n + n[x])))
        for y in linked[np.unique(place[linked], return_index=True)[1]]:
            found.append((int(node[x]), int(node[y])))
            place[place == place[y]] = place[x]
    return found


def _linked(batches):
    """``link_members`` over the blocks of rows sorted by (key, block); a block may go on in the next batch."""

    def emit(rows):
        numbers = [rows.column(c).to_numpy() for c in ("key", "block", "node", "n", "root", "role")]
        key, block = numbers[:2]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        starts, found = np.flatnonzero(new), []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(key)).tolist()):
            sets = rows.column("shingles").slice(a, b - a).combine_chunks().flatten().to_numpy()
            found += link_members(*(x[a:b] for x in numbers[2:]), sets)
        u, v = np.array(found, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        key, block = rows.column("key").to_numpy(), rows.column("block").to_numpy()
        cut = int(((key == key[-1]) & (block == block[-1])).argmax())
        if cut:
            yield emit(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield emit(held)


def _open(met: DataFrame, roots: DataFrame | None, block: int) -> DataFrame:
    """Rows (key, block, node, n, root, role) of the buckets with several components, in blocks of about ``block`` shingles on either side.

    Role 0: in the component with most shingles. 1: outside, asks. In a bucket of several blocks the members are dealt into parts, those
    outside also into groups, and each part meets each group: 2 is outside in its part, 3 asks in its group.
    """
    if roots is None:
        placed = met.select("key", "node", "n", F.col("node").alias("root"))
    else:
        placed = met.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    members = (F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("mixed"))
    sizes = placed.groupBy("key", "root").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("rows"), *members)
    mixed = (F.min("low").alias("low"), F.max("high").alias("high"), F.bit_xor("mixed").alias("mixed"), F.sum("rows").alias("rows"))
    whole = sizes.groupBy("key").agg(
        F.max(F.struct("size", "root")).alias("main"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("roots"), *mixed
    )
    # Buckets of the same members say the same: one of them is enough.
    whole = whole.where("roots > 1").groupBy("low", "high", "mixed", "rows").agg(F.min(F.struct("key", "main", "size")).alias("one")).select("one.*")
    whole = whole.select(
        "key", F.col("main.root").alias("main"), F.ceil(F.col("size") / block).alias("parts"),
        F.ceil((F.col("size") - F.col("main.size")) / block).alias("groups"),
    )
    outside, number = F.col("root") != F.col("main"), F.xxhash64("node", "key")
    part, group = F.pmod(number, F.col("parts")), F.pmod(F.xxhash64("key", "node"), F.col("groups"))
    here = F.transform(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1), lambda g: F.struct((part * F.col("groups") + g).alias("block"), F.when(outside, 2).otherwise(0).alias("role")))
    asked = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.struct((p * F.col("groups") + group).alias("block"), F.lit(3).alias("role")))
    one = F.array(F.struct(F.lit(0).cast("long").alias("block"), outside.cast("int").alias("role")))
    blocks = F.when(F.col("parts") == 1, one).when(outside, F.concat(here, asked)).otherwise(here)
    return placed.join(whole, "key").select("key", "node", "n", "root", F.explode(blocks).alias("b")).select("key", "b.block", "node", "n", "root", "b.role")


def _closed(met: DataFrame, roots: DataFrame | None, sets: DataFrame, block: int) -> DataFrame | None:
    """Components (node, root) after all links between members of a bucket."""
    rows = _open(met, roots, block).join(sets, "node")
    ordered = rows.repartition(task_count(met.sparkSession), "key", "block").sortWithinPartitions("key", "block")
    columns = ("key", "block", "node", "n", "root", "role", "shingles")
    fresh = cut_lineage(ordered.select(*columns).mapInArrow(_linked, "u bigint, v bigint").distinct())
    n = fresh.count()
    return _joined(roots, fresh, n) if n else roots


def fingerprint_candidates(nodes: DataFrame) -> DataFrame:
    """(u, v, apart): nodes (node, fp) that SimHash links, ``simhash.LIMIT`` or fewer bits apart, by its pigeonhole keys.

    Nodes of one fingerprint meet in the smallest of them, which stands for the fingerprint in its links.
    """
    firsts = cut_lineage(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    equal = nodes.join(firsts, "fp").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"), F.lit(0).cast("long").alias("apart"))
    edges = simhash.links(firsts.select("fp"), simhash.LIMIT).selectExpr("u as fu", "v as fv").distinct()
    named = edges.join(firsts.selectExpr("fp as fu", "first as u"), "fu").join(firsts.selectExpr("fp as fv", "first as v"), "fv")
    return equal.unionByName(named.select("u", "v", F.bit_count(F.col("fu").bitwiseXOR(F.col("fv"))).cast("long").alias("apart")))


def _sets_of(docs: DataFrame, marked: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of ``nodes`` (node), once each, from one of their texts in ``docs``."""
    ids = marked.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("text_hash", "doc_id")).alias("one"))
    ids = ids.select("one.*").distinct()
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    texts = texts.join(
        ids, texts["doc_id"].eqNullSafe(ids["doc_id"]) & (texts["text_hash"] == ids["text_hash"]), "left_semi"
    )
    return _sets(texts, size).join(nodes, "node", "left_semi").dropDuplicates(["node"])


def links(docs: DataFrame, marked: DataFrame, size: int = SIZE, run_rows: int = RUN_ROWS, block: int = BLOCK) -> DataFrame | None:
    """Components (node, root) of the nodes that have links, null without any; ``marked`` has the signatures of ``docs``."""
    nodes = marked.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "fp", "keys")])
    close = fingerprint_candidates(nodes.select("node", "fp"))
    met = cut_lineage(_members(nodes, run_rows))
    runs = cut_lineage(_runs(met))
    # Both sources are settled at once: each settling costs the driver the plans of several rounds of components.
    tested = cut_lineage(close.unionByName(_candidates(runs, None, walk_run)).distinct())
    # All that may be compared: texts are shuffled once for the walks and the closing.
    ends = tested.select(F.explode(F.array("u", "v")).alias("node")).unionByName(met.select("node"))
    sets = cut_lineage(_sets_of(docs, marked, cut_lineage(ends.distinct()), size))
    roots, found = _settle(tested, None, sets)
    if found:
        # What was verified before is not tried again; candidates inside components do not come back.
        more = _candidates(runs, roots, walk_apart).join(tested.select("u", "v"), ["u", "v"], "left_anti")
        roots, _ = _settle(more, roots, sets)
    return _closed(met, roots, sets, block)


def near_copies(docs: DataFrame, size: int = SIZE, run_rows: int = RUN_ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, node, component_id, first): the smallest doc_id among documents reachable over links, for each row.

    ``first`` marks the row that stays: one of those with the component's smallest id (rows that repeat it are marked alike).
    """
    marked = cut_lineage(signatures(docs, size))
    roots = links(docs, marked, size, run_rows, block)
    placed = marked.select("doc_id", "text_hash", "node")
    if roots is not None:
        placed = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        placed = placed.withColumn("root", F.col("node"))
    placed = cut_lineage(placed)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    least = placed.groupBy("root").agg(F.min(order).alias("one"))
    joined = placed.join(least, "root")
    first = F.col("doc_id").eqNullSafe(F.col("one.id")) & (F.col("text_hash") == F.col("one.hash"))
    return joined.select("doc_id", "text_hash", "node", F.col("one.id").alias("component_id"), first.alias("first"))


def keep_first(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, one of each component, with all their columns."""
    found = cut_lineage(near_copies(docs, size).where("first"))
    chosen = found.select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash")).distinct()
    marked = docs.withColumn("__hash", F.xxhash64("text"))
    kept = marked.join(chosen, marked["doc_id"].eqNullSafe(chosen["f_id"]) & (marked["__hash"] == chosen["f_hash"]), "left_semi")
    if found.count() > chosen.count():  # rows that repeat both id and text
        kept = kept.dropDuplicates(["doc_id", "__hash"])
    return kept.drop("__hash")
