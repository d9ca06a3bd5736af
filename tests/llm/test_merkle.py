"""The manifest against a tree built by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kinomill.llm import merkle
from kinomill.session import scratch_path

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(digests):
    """Root, and per leaf the (left, right) siblings from bottom to top."""
    paths, members, now = [[] for _ in digests], [[i] for i in range(len(digests))], digests
    while len(now) > 1:
        up, held = [], []
        for a in range(0, len(now), 3):
            run = now[a : a + 3]
            for j in range(len(run)):
                for m in members[a + j]:
                    paths[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            held.append(sum(members[a : a + 3], []))
        now, members = up, held
    return now[0], paths


def by_hand(rows):
    parts = {}
    for i, r in enumerate(rows):
        parts.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), i))
    order = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: tree([x[2] for x in sorted(parts[s])]) for s in order}
    root, above = tree([made[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, above):
        for (_, _, own, i), path in zip(sorted(parts[s]), made[s][1]):
            r, steps, h = rows[i], path + top, own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                h = leaf(r, r[4].replace("\n", ""))
            for a, b in steps:
                h = sha(a + h + b)
            out.append((r[0], own, made[s][0], root, sha("".join(a + b for a, b in steps)), h, h == root))
    return sorted(out, key=repr)


def proved(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return merkle.verify(docs, scratch_path(spark, "merkle"), even, F.replace("text", F.lit("\n"), F.lit("")))


def test_against_a_tree_by_hand(spark):
    rnd = random.Random(1)
    rows = [
        (
            rnd.choice([None, *range(300)]),
            rnd.choices([None, "", "a", "é", "z"], [1, 1, 300, 2, 40])[0],
            rnd.choice([None, "en"]),
            rnd.choice([None, 4]),
            rnd.choice([None, "", "a\nb", "\n", "x", "long " * 20_000]),
        )
        for _ in range(900)
    ]
    rows += rows[:20]
    assert sorted(map(tuple, proved(spark, rows).collect()), key=repr) == by_hand(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 81, 82, 244])
def test_heights(spark, n):
    rows = [(i, "s", "e", 1, "t\n") for i in range(n)]
    assert sorted(map(tuple, proved(spark, rows).collect()), key=repr) == by_hand(rows)


def test_labels_nest(spark):
    """Every node's interval is that of its children together, and its digest theirs."""
    leaves = spark.range(300).select(
        F.when(F.col("id") < 270, "big").when(F.col("id") < 271, "one").otherwise("small").alias("part"),
        F.col("id").alias("doc_id"),
        F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"),
    )
    forest = merkle.Forest.write(leaves, ["doc_id"], scratch_path(spark, "forest"))
    nodes = {(r["part"], r["level"], r["lo"]): (r["hi"], r["digest"]) for r in forest.nodes().collect()}
    assert len(nodes) == forest.nodes().count()
    tops = {r["part"]: (r["n"], r["digest"]) for r in forest.roots().collect()}
    assert {p: n for p, (n, _) in tops.items()} == {"big": 270, "one": 1, "small": 29}
    for (part, level, lo), (hi, digest) in nodes.items():
        if level:
            inside = sorted((a, *nodes[part, level - 1, a]) for p, k, a in nodes if p == part and k == level - 1 and lo <= a < hi)
            assert inside[0][0] == lo and inside[-1][1] == hi and sha("".join(x[2] for x in inside)) == digest
            assert all(x[1] == y[0] for x, y in zip(inside, inside[1:])) and len(inside) <= 3
        if (lo, hi) == (0, tops[part][0]) and (part, level + 1, 0) not in nodes:
            assert digest == tops[part][1]
