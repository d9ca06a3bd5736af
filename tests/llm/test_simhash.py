import numpy as np
import pytest
import xxhash

from kinomill.llm import simhash


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, limit=4):
    left, out = set(range(len(ids))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            x = todo.pop()
            group.append(x)
            near = {y for y in left if (fps[x] ^ fps[y]).bit_count() <= limit}
            left -= near
            todo += near
        known = [ids[i] for i in group if ids[i] is not None]
        for i in group:
            out[i] = min(known, default=None)
    return [out[i] for i in range(len(ids))]


@pytest.mark.parametrize("hot_run", [simhash.HOT_RUN, 3])
def test_documents_against_brute_force(spark, small, hot_run):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = [(900, ""), (901, None), (902, "One"), (903, "one"), (None, "a b c d e"), (904, "ß Ä a b c d e f"), (904, "ß Ä a b c d e f")]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = docs.collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    got = [(r["doc_id"] if r["doc_id"] is not None else -1, r["fp"] % (1 << 64), r["component_id"] if r["component_id"] is not None else -1) for r in simhash.near_duplicates(docs, hot_run=hot_run).collect()]
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, f, -1 if c is None else c) for r, f, c in zip(rows, fps, slow_components([r["doc_id"] for r in rows], fps)))
    assert sorted(got) == want


@pytest.mark.parametrize("hot_run", [simhash.HOT_RUN, 40])
def test_chains_and_dense_groups(spark, hot_run):
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(12):  # chains of steps of up to four bits, and clouds around a centre
        x = int(rng.integers(0, 1 << 63))
        for _ in range(30):
            values.add(x)
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
    centre = int(rng.integers(0, 1 << 63))
    for _ in range(120):
        values.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
    values = sorted(values)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), hot_run=hot_run)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    got = [roots.get(v, v) for v in signed]
    assert got == slow_components(signed, values)
    if hot_run == simhash.HOT_RUN:
        assert edges.count() < 5 * 30 * len(values)


def test_thresholds_cover_the_limit():
    n, both = 1000, np.full((64, 64), 250)
    np.fill_diagonal(both, np.linspace(100, 900, 64).astype(int))
    for parts in range(2, 9):
        groups = simhash.group_bits(n, both, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        _, thresholds = simhash.allocate(n, np.diag(both) / n, groups, 4)
        assert sum(t + 1 for t in thresholds) == 5


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string, fp string")).collect() == []
