"""Exact deduplication, mixing and sharding against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinomill.llm import exact_dedup, mixing, sharding

DOCS = [
    (5, "a  b", "s1"), (3, "a b", "s1"), (3, "a b", "s2"), (9, "a\tb", None), (1, None, "s1"), (2, "", "s2"),
    (None, "lonely", "s3"), (None, "a b", "s3"), (7, " a b", "s3"), (8, "é" * 90_000, "s4"), (8, "other", "s4"),
]


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*d, 1, True) for d in DOCS], "doc_id long, text string, source string, n long, kept boolean")


def test_one_batch(spark, docs, tmp_path):
    found = exact_dedup.deduplicate(docs, exact_dedup.DigestIndex.open(spark, str(tmp_path), 4)).collect()
    groups = defaultdict(list)
    for d in DOCS:
        groups[digest(d[1])].append(d[0])
    want = Counter()
    for h, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda x: (x is None, x))):
            want[(i, keep, len(ids), n == 0, h)] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in found) == want


def test_later_batches_meet_the_index(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path), 4)
    exact_dedup.deduplicate(docs, index)
    size = index.rows().count()
    again = exact_dedup.DigestIndex.open(spark, str(tmp_path), 4)  # another session would open it like this
    later = spark.createDataFrame([(0, "a b"), (20, "new"), (21, "new")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in exact_dedup.deduplicate(later, again).collect()}
    assert (found[0]["kept"], found[0]["keep_id"]) == (False, 3)
    assert found[20]["kept"] and not found[21]["kept"] and found[21]["keep_id"] == 20
    assert again.rows().count() == size + 1
    exact_dedup.deduplicate(later, again)
    assert again.rows().count() == size + 1
    plan = again.unseen(spark.createDataFrame([(b"x", 1, 1, "b")], exact_dedup.SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_a_batch_again_keeps_the_same(spark, docs, tmp_path):
    """A job that died after the index was appended is repeated, with a name for the batch or without."""
    index = exact_dedup.DigestIndex.open(spark, str(tmp_path), 4)
    first = Counter(map(tuple, exact_dedup.deduplicate(docs, index).collect()))
    size = index.rows().count()
    assert Counter(map(tuple, exact_dedup.deduplicate(docs.repartition(3), index).collect())) == first
    assert index.rows().count() == size and sum(r[3] for r in first) == size
    more = docs.where("doc_id >= 0").withColumn("text", F.concat("text", F.lit("?")))
    named = [Counter(map(tuple, exact_dedup.deduplicate(more, index, "monday").collect())) for _ in range(2)]
    assert named[0] == named[1] and index.rows().count() == size + sum(r[3] for r in named[0].elements())


def test_rows_that_stay(spark, docs, tmp_path):
    kept = exact_dedup.keep_first(docs, exact_dedup.DigestIndex.open(spark, str(tmp_path), 4))
    assert kept.columns == docs.columns
    assert Counter(digest(r["text"]) for r in kept.collect()) == Counter({digest(d[1]): 1 for d in DOCS})


def test_empty_batch(spark, docs, tmp_path):
    assert exact_dedup.deduplicate(docs.limit(0), exact_dedup.DigestIndex.open(spark, str(tmp_path), 4)).collect() == []
    assert mixing.mix(docs.limit(0)).collect() == []
    assert sharding.shard_documents(docs.limit(0)).collect() == []


def water(sizes, weights, total):
    """Targets by stopping sources one round after the other."""
    stopped, out = {}, {}
    while True:
        open_ = [s for s in sizes if s not in stopped]
        left = total - sum(stopped.values())
        out = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_} if open_ else {}
        over = [s for s in open_ if out[s] > 2 * sizes[s]]
        if not over:
            return out | stopped
        stopped |= {s: 2.0 * sizes[s] for s in over}


def check_mix(rows, found):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = water(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    return taken, targets, largest


def test_mix_small(spark, docs):
    found = mixing.mix(docs).collect()
    assert len(found) == len(DOCS)
    check_mix([d[:3] for d in DOCS], found)


def test_mix_comes_near_its_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = mixing.mix(docs).collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    taken, targets, largest = check_mix(rows, found)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in targets)
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    repeated = mixing.repeat(docs, mixing.mix(docs))
    assert repeated.columns == docs.columns
    assert Counter(r["doc_id"] for r in repeated.collect()) == Counter({r["doc_id"]: r["copies"] for r in found if r["copies"]})


def test_larger_budgets_take_supersets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    less, more = ({r["doc_id"] for r in mixing.mix(docs, share=s).collect() if r["copies"]} for s in (0.2, 0.4))
    assert less and less < more


def minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, n, run = (low + high) // 2, 1, 0
        for s in sizes:
            if run + s > middle:
                n, run = n + 1, 0
            run += s
        low, high = (low, middle) if n <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("step_bits", [12, 3])
def test_shards(spark, small, step_bits, monkeypatch):
    monkeypatch.setattr(sharding, "STEP_BITS", step_bits)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(d[0], d[1]) for d in DOCS], "doc_id long, text string"))
    rows = sharding.shard_documents(docs, 8).collect()
    keyed = docs.selectExpr("xxhash64(coalesce(text, '')) & %d as key" % ((1 << 60) - 1), "octet_length(coalesce(text, '')) + 1 as size")
    sizes = [r["s"] for r in keyed.groupBy("key").agg({"size": "sum"}).withColumnRenamed("sum(size)", "s").orderBy("key").collect()]
    loads, slots, of_text = Counter(), defaultdict(list), {}
    texts = {(r["doc_id"], len((r["text"] or "").encode()) + 1): r["text"] or "" for r in docs.collect()}
    for r in rows:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text.setdefault(texts[(r["doc_id"], r["size"])], set()).add(r["shard"])
    assert sum(loads.values()) == sum(sizes) and set(loads) <= set(range(8))
    assert max(loads.values()) == minimax(sizes, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())


@pytest.mark.parametrize("sizes", [[5], [1] * 8, [1, 9, 1, 1, 1, 1, 1, 30, 2, 2], list(range(1, 200))])
def test_cuts_of_given_groups(spark, sizes):
    keys = [i * ((1 << 60) // (len(sizes) + 1)) + i for i in range(len(sizes))]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    capacity, firsts = sharding.minimax_cuts(groups, 8)
    assert capacity == minimax(sizes, 8)
    loads = Counter()
    for k, s in zip(keys, sizes):
        loads[sum(k >= f for f in firsts)] += s
    assert max(loads.values()) == capacity and len(loads) <= 8


@pytest.mark.parametrize("sizes", [[30, *[1] * 60], [*[1] * 30, 30, *[1] * 30], [9, *[1] * 20, 40, 2, 2, 25, *[1] * 9], [5] * 9, [3, 50, 4]])
@pytest.mark.parametrize("step_bits", [12, 3])
def test_no_shard_is_empty(spark, sizes, step_bits, monkeypatch):
    monkeypatch.setattr(sharding, "STEP_BITS", step_bits)
    keys = [i * ((1 << 60) // (len(sizes) + 1)) + i for i in range(len(sizes))]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    capacity, firsts = sharding.balanced_cuts(groups, 8)
    loads = Counter()
    for k, s in zip(keys, sizes):
        loads[sum(k >= f for f in firsts)] += s
    assert capacity == max(loads.values()) == minimax(sizes, 8)
    assert len(loads) == min(8, len(sizes))
    if sizes[:2] == [30, 1]:
        assert sorted(loads.values())[-2] == 9  # 60 ones in seven shards
