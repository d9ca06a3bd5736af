"""Near copies of the pipeline against all pairs of shingle sets in plain Python."""

import random

import corpus_pipeline
from kinomill.llm import near_copies
from kinomill.llm.simhash import LOWER


def shingles(text, size=5):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def slow_components(texts):
    """Number of each text's component, by comparing all pairs."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


def made_texts():
    """Copies with a few words changed around bases, chains of small changes, and short texts."""
    rng, texts = random.Random(5), []
    for n in (30, 120, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(25):
            copy = base[:]
            for at in rng.sample(range(n), rng.randint(1, max(1, n // 35))):
                copy[at] = f"x{rng.randrange(10**9)}"
            texts.append(" ".join(copy))
        chain = [f"c{rng.randrange(5000)}" for _ in range(n)]
        for step in range(12):
            chain[step * n // 12] = f"y{rng.randrange(10**9)}"
            texts.append(" ".join(chain))
    return [*texts, "a b", "A  b", "a b c d e", "a b c d e f", "", None, " \n", texts[0].upper()]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {}
    for (i, _), r in zip(rows, slow_components([t for _, t in rows])):
        want.setdefault(r, set()).add(i)
    want = {i: min(group) for group in want.values() for i in group}
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert got == want
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_made_groups_against_all_pairs(spark):
    check(spark, list(enumerate(made_texts())))


def test_documents_against_all_pairs(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    check(spark, rows)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert 1 in kept and 177 not in kept  # similarity 0.83, nine bits of SimHash apart


def test_large_runs_are_dealt(spark):
    """Runs of a few rows only: parts of a bucket meet through their leaders."""
    texts = made_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = slow_components(texts)
    want = {i: min(j for j, r in enumerate(roots) if r == root) for i, root in enumerate(roots)}
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs, run_rows=8).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    assert all(roots[i] == roots[got[i]] for i in got)  # never a link that is none


def test_walks():
    import numpy as np

    node, n = np.arange(4), np.full(4, 10)
    fp = np.array([0, 1, (1 << 40) - 1, (1 << 40) - 2], np.uint64)
    found = np.concatenate(near_copies.walk_run(node, n, fp, node), axis=1).T.tolist()
    assert found == [[1, 0, 1], [3, 2, 1]]
    root = np.array([0, 1, 0, 0])
    assert np.concatenate(near_copies.walk_apart(node, n, fp, root), axis=1).T.tolist() == [[1, 0, 1]]


def test_fingerprints_find_links_without_buckets(spark):
    """SimHash is no mere sketch: without any MinHash bucket, links of at most four bits are found by its pigeonhole keys."""
    from pyspark.sql import functions as F

    texts = made_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = near_copies.signatures(docs).localCheckpoint()
    fps, node = ({r["doc_id"]: r[c] for r in marked.collect()} for c in ("fp", "node"))
    roots = near_copies.links(docs, marked.withColumn("keys", F.array().cast("array<bigint>")))
    assert roots is not None
    root = {r["node"]: r["root"] for r in roots.collect()}
    right, sets, near = slow_components(texts), [shingles(t) for t in texts], 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            alike = 5 * len(a & b) >= 4 * len(a | b)
            if alike and node[i] != node[j] and ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4:
                near += root[node[i]] == root[node[j]]
            if root.get(node[i], -1) == root.get(node[j], -2):
                assert right[i] == right[j]
    assert near > 20
    pairs = near_copies.fingerprint_candidates(marked.select("node", "fp").distinct()).collect()
    of = {n: fps[i] & (2**64 - 1) for i, n in node.items()}
    assert all((of[r["u"]] ^ of[r["v"]]).bit_count() == r["apart"] <= 4 for r in pairs)


def test_both_sources_are_settled_at_once(spark, monkeypatch):
    """One settling for candidates of both sources: each one leaves the driver the plans of several rounds of components."""
    docs, waiting, settle = spark.createDataFrame(list(enumerate(made_texts())), "doc_id long, text string"), [], near_copies._settle
    monkeypatch.setattr(near_copies, "_settle", lambda pairs, *rest: waiting.append(pairs) or settle(pairs, *rest))
    marked = near_copies.signatures(docs).localCheckpoint()
    near_copies.links(docs, marked)
    first = {(r["u"], r["v"]) for r in waiting[0].collect()}
    assert {(r["u"], r["v"]) for r in near_copies.fingerprint_candidates(marked.select("node", "fp").distinct()).collect()} < first
    assert waiting[0].where("apart > 4").count() > 0


def test_parts_and_blocks_lose_no_link(spark):
    """Runs of a few rows and blocks of a few shingles: members of different parts that no leader reaches are compared as well."""
    texts = made_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = slow_components(texts)
    want = {i: min(j for j, r in enumerate(roots) if r == root) for i, root in enumerate(roots)}
    for rows, block in ((3, 2_000_000), (8, 300)):
        got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs, run_rows=rows, block=block).collect()}
        assert got == want


def test_links_of_many_bits(spark):
    """Texts of similarity 0.8 whose fingerprints differ in more bits than the walks allow."""
    rng, rows = random.Random(3), []
    while len(rows) < 6:
        words = [f"w{rng.randrange(10**9)}" for _ in range(9)]
        texts = " ".join(words), " ".join(words[:8])
        a, b = (near_copies.majority(x) for x in near_copies.shingle_sets([t.encode() for t in texts]))
        if (a ^ b).bit_count() > near_copies.BITS_APART:
            rows += [(len(rows), texts[0]), (len(rows) + 1, texts[1])]
    check(spark, rows)


def test_links_behind_nearer_strangers(spark):
    """Members of a bucket whose nearest ones by fingerprint are no copies: those further off are compared too."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"])]
    texts += [" ".join(f"z{rng.randrange(10**9)}" for _ in range(60)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = near_copies.signatures(docs)
    # One bucket; the strangers' fingerprints lie five to seven bits off, in different bits, the copy's nine.
    bits = F.expr("case when doc_id = 0 then 0L when doc_id = 1 then shiftleft(511L, 50) else shiftleft(31L, cast(doc_id as int) * 4 - 8) end")
    marked = marked.withColumn("fp", bits).withColumn("keys", F.array(F.lit(7).cast("long"))).localCheckpoint()
    node = {r["doc_id"]: r["node"] for r in marked.collect()}
    roots = near_copies.links(docs, marked)
    assert {r["node"] for r in roots.collect()} == {node[0], node[1]}


def test_link_members_against_all_pairs():
    import numpy as np

    rng = np.random.default_rng(4)
    for role in (np.r_[np.zeros(20, int), np.ones(20, int)], np.r_[np.zeros(10, int), np.full(15, 2), np.full(15, 3)]):
        sets = [np.sort(rng.choice(14, rng.integers(8, 14), replace=False)) for _ in role]
        node, n = rng.permutation(40), np.array([len(s) for s in sets])
        linked = near_copies.link_members(node, n, node, role, np.concatenate(sets))
        want = list(range(40))
        for i in range(40):
            for j in range(40):
                both, asks = len(set(sets[i]) & set(sets[j])), role[i] % 2 and (role[j] == 0 or role[j] < 3 and node[j] < node[i])
                if asks and 9 * both >= 4 * (n[i] + n[j]):
                    want = [want[i] if r == want[j] else r for r in want]
        got, at = list(range(40)), {int(x): i for i, x in enumerate(node)}
        for u, v in linked:
            assert got[at[u]] != got[at[v]]  # never a second link between two components
            got = [got[at[u]] if r == got[at[v]] else r for r in got]
        assert len({(a, b) for a, b in zip(got, want)}) == len(set(got)) == len(set(want))


def test_empty(spark):
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []
