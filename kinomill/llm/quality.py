"""Quality by perplexity: an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

Training counts the n-grams of the trusted documents of each language (each task
sends every n-gram once), takes continuation counts for the lower orders with group-bys
and Kneser-Ney's three discounts per order from the counts of counts. The model is
cut into shards by the last two characters of the context; a shard has all it
needs for its n-grams, as the orders up to two are in every shard.

Scoring packs the n-grams of a run of documents by shard, each with the places
it is found at (document number and count), and joins these packs with the
model's shards. How many shards there are follows from the number of n-grams in
the model, not from the data. A pack needs no other pack, so packs are salted by their run and
shards are sent once per salt. Each join gives one partial sum per document and shard; their sum is the document's
log-probability. Texts are read once for training and once for scoring and never shuffled.

A document is kept if its perplexity is at most the ``quantile`` of trusted documents of its
language that the model has not learned from, a fixed share of them set aside by a checksum of the
id (a mergeable quantile sketch with a rank error of 1/10,000).

Defined results: null and empty texts have no perplexity and are kept, and so are documents in
languages without trusted text; null is a language of its own. Ids may repeat or be null; a
trusted id makes all its rows trusted. Documents are numbered inside runs of one task, so
``docs`` must come from files or another input that a repeated task reads in the same order.
An empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomill.llm.common import task_count
from kinomill.llm.hashing import finish
from kinomill.session import cut_lineage

START = 0x110000  # stands before the first character
CHARS_PER_RUN = 5_000_000
DENSE = 1 << 24
SHARD_GRAMS = 100_000  # n-grams of the model per shard, on average
BROADCAST_IDS = 5_000_000  # trusted ids: 8 bytes each; beyond, Spark chooses the join
NO_LANGUAGE = "\x00"


def padded_codes(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after order - 1 start signs, and the text number of each code."""
    lengths = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(lengths) - lengths
    codes = np.insert(raw, np.repeat(begins, order - 1), START)
    return codes, np.repeat(np.arange(len(texts)), lengths + order - 1)


def _ranked(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key among the distinct ones, and a place of each distinct key."""
    if size <= DENSE:
        seen = np.full(size, -1, np.int32)
        seen[key] = np.arange(len(key), dtype=np.int32)
        found = np.flatnonzero(seen >= 0)
        place = seen[found]
        seen[found] = np.arange(len(found), dtype=np.int32)
        return seen[key].astype(np.int64), place
    _, place, rank = np.unique(key, return_index=True, return_inverse=True)
    return rank, place


def grams_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams (a row of codes each), the number of each occurrence's n-gram, and its text number."""
    codes, owner = padded_codes(texts, order)
    if len(codes) < order:
        return np.zeros((0, order), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    char, place = _ranked(codes.astype(np.int64), START + 1)
    alphabet = len(place)
    rank = char
    for i in range(1, order):
        key = rank[:-1] * alphabet + char[i:]
        rank, place = _ranked(key, (int(rank.max()) + 1) * alphabet)
    # An n-gram ends at a character of the text that also owns its first code.
    last = owner[order - 1 :]
    own = last == owner[: len(last)]
    rank, last = rank[own], last[own]
    used, rank = np.unique(rank, return_inverse=True)
    places = place[used]
    return np.stack([codes[places + i] for i in range(order)], axis=1), rank, last


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """64-bit keys of rows of codes."""
    key = np.full(len(grams), grams.shape[1], np.uint64)
    for i in range(grams.shape[1]):
        key = finish(key * np.uint64(3) + grams[:, i].astype(np.uint64) + np.uint64(1))
    return key


def _shard_of(first: np.ndarray, second: np.ndarray, shards: int) -> np.ndarray:
    return (finish(first.astype(np.uint64) << np.uint64(24) | second.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _runs(batches):
    """Documents in runs of about CHARS_PER_RUN characters, across batches."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            size += len(row["text"])
            if size >= CHARS_PER_RUN:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) of ``docs`` (text, lang): gram holds the codes, four bytes each."""

    def run(batches):
        for rows in _runs(batches):
            for lang in sorted({r["lang"] for r in rows}):
                grams, rank, _ = grams_of([r["text"] for r in rows if r["lang"] == lang], order)
                n = np.bincount(rank, minlength=len(grams))
                data = np.ascontiguousarray(grams.astype("<u4")).tobytes()
                width = 4 * order
                packed = [data[i : i + width] for i in range(0, len(data), width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array(packed, pa.binary()), pa.array(n)], names=["lang", "gram", "n"]
                )

    counted = docs.select("text", "lang").mapInArrow(run, "lang string, gram binary, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(counts_of_counts: list, order: int) -> dict:
    """{lang: array of order + 1 rows (D1, D2, D3)} from rows (lang, k, a, types) with a from 1 to 4."""
    seen: dict = {}
    for row in counts_of_counts:
        seen.setdefault(row["lang"], np.zeros((order + 1, 5)))[row["k"], row["a"]] = row["types"]
    out = {}
    for lang, n in seen.items():
        d = np.zeros((order + 1, 3))
        for k in range(1, order + 1):
            n1, n2, n3, n4 = n[k, 1:]
            y = n1 / (n1 + 2 * n2) if n1 else 0.5
            for i, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
                d[k, i - 1] = min(max(i - (i + 1) * y * high / low, 0.0), i) if low else i * y
        out[lang] = d
    return out


def _order_tables(rows: dict, d: np.ndarray, order: int) -> list:
    """Per order: sorted n-gram keys with their discounted share, sorted context keys with their back-off weight."""
    tables = [None]
    for k in range(1, order + 1):
        grams, a = rows.get(k, (np.zeros((0, k), np.uint32), np.zeros(0, np.int64)))
        context, inverse = np.unique(gram_keys(grams[:, : k - 1]), return_inverse=True)
        total = np.bincount(inverse, a, len(context))
        step = d[k][np.minimum(a, 3) - 1]
        weight = np.bincount(inverse, step, len(context)) / np.maximum(total, 1)
        key = gram_keys(grams)
        at = np.argsort(key)
        share = (np.maximum(a - step, 0) / np.maximum(total[inverse], 1))[at]
        tables.append((key[at], share.astype(np.float32), context, weight.astype(np.float32)))
    return tables


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def log_probabilities(tables: list, alphabet: int, grams: np.ndarray, order: int) -> np.ndarray:
    """Natural logarithm of the interpolated probability of each n-gram's last character."""
    p = np.full(len(grams), 1.0 / (alphabet + 1))
    for k in range(1, order + 1):
        tail = grams[:, order - k :]
        keys, share, context, weight = tables[k]
        p = _look(keys, share, gram_keys(tail), 0.0) + _look(context, weight, gram_keys(tail[:, : k - 1]), 1.0) * p
    return np.log(p)


def model_shards(counts: DataFrame, order: int) -> tuple[DataFrame, int]:
    """(shard, model) from n-gram counts (lang, gram, n), and the number of shards."""
    table = counts.select("lang", F.lit(order).alias("k"), "gram", F.col("n").alias("a"))
    levels = [table]
    for k in range(order - 1, 0, -1):
        shorter = F.substring("gram", 5, 4 * k)
        levels.append(
            levels[-1].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("a")).select("lang", F.lit(k).alias("k"), "gram", "a")
        )
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    grams = cut_lineage(grams)
    shards = max(1, -(-grams.where("k > 2").count() // SHARD_GRAMS))
    few = grams.where("a <= 4").groupBy("lang", "k", F.col("a").cast("int").alias("a")).agg(F.count(F.lit(1)).alias("types"))
    by_language = discounts(few.collect(), order)  # four numbers per language and order
    sizes = {r["lang"]: r["n"] for r in grams.where("k = 1").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}

    def place(batches):
        for batch in batches:
            k = batch.column("k").to_numpy()
            data = batch.column("gram").to_pylist()
            shard = np.full(len(k), -1, np.int32)
            for own in range(3, order + 1):
                at = np.flatnonzero(k == own)
                if len(at):
                    codes = np.frombuffer(b"".join(data[i] for i in at), "<u4").reshape(-1, own)
                    shard[at] = _shard_of(codes[:, own - 3], codes[:, own - 2], shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], names=["shard", *batch.schema.names])

    placed = grams.mapInArrow(place, "shard int, lang string, k int, gram binary, a long")
    # Characters and pairs of characters go to every shard.
    everywhere = placed.where("k <= 2").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def build(table: pa.Table) -> pa.Table:
        model = {}
        langs = np.array(table.column("lang").to_pylist(), object)
        k, a, data = table.column("k").to_numpy(), table.column("a").to_numpy(), table.column("gram").to_pylist()
        for lang in set(langs):
            rows = {}
            for own in range(1, order + 1):
                at = np.flatnonzero((langs == lang) & (k == own))
                codes = np.frombuffer(b"".join(data[i] for i in at), "<u4").reshape(-1, own)
                rows[own] = (codes, a[at])
            model[lang] = (_order_tables(rows, by_language[lang], order), sizes[lang])
        packed = zstandard.compress(pickle.dumps(model), 3)
        return pa.table({"shard": table.column("shard").slice(0, 1), "model": pa.array([packed], pa.binary())})

    built = placed.where("k > 2").unionByName(everywhere).groupBy("shard").applyInArrow(build, "shard int, model binary")
    return built, shards


PACK = "shard int, run long, number int, doc_id long, lang string, chars long, pack binary"


def packs_of(docs: DataFrame, order: int, shards: int) -> DataFrame:
    """Packed n-grams by run, language and shard, and a row (shard -1) for each document of a run."""
    names = [x.split()[0] for x in PACK.split(", ")]

    def run(batches):
        seen = 0
        for rows in _runs(batches):
            number = (TaskContext.get().partitionId() << 32) | seen
            seen += 1
            none = [None] * len(rows)
            columns = [[-1] * len(rows), [number] * len(rows), list(range(len(rows))), [r["doc_id"] for r in rows]]
            columns += [[r["lang"] for r in rows], [len(r["text"]) for r in rows], none]
            yield _batch(columns)
            for lang in sorted({r["lang"] for r in rows}):
                own = np.array([i for i, r in enumerate(rows) if r["lang"] == lang])
                grams, rank, text = grams_of([rows[i]["text"] for i in own], order)
                if not len(grams):
                    continue
                pair, times = np.unique(rank * len(own) + text, return_counts=True)
                gram, text = pair // len(own), own[pair % len(own)]
                shard = _shard_of(grams[:, order - 3], grams[:, order - 2], shards)
                order_by = np.argsort(shard[gram], kind="stable")
                gram, text, times = gram[order_by], text[order_by], times[order_by]
                ends = np.searchsorted(shard[gram], np.arange(shards + 1))
                found = [s for s in range(shards) if ends[s] < ends[s + 1]]
                packs = [_pack(grams, *(x[ends[s] : ends[s + 1]] for x in (gram, text, times))) for s in found]
                n = len(found)
                yield _batch([found, [number] * n, [None] * n, [None] * n, [lang] * n, [None] * n, packs])

    def _batch(columns):
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select("doc_id", "text", "lang").mapInArrow(run, PACK)


def _pack(grams, gram, text, times) -> bytes:
    """Columns of codes of the distinct n-grams, documents per n-gram, documents (as differences) and counts, compressed."""
    used, first = np.unique(gram, return_index=True)
    per_gram = np.diff(np.append(first, len(gram)))
    step = np.diff(text, prepend=0)
    step[first] = text[first]
    parts = [grams[used].T.astype("<u4"), per_gram.astype("<u4"), step.astype("<u2" if step.max() < 1 << 16 else "<u4")]
    small = times.max() < 256
    head = np.array([len(used), len(gram), parts[2].itemsize, 1 if small else 4], "<u4")
    data = b"".join(x.tobytes() for x in (head, *parts, times.astype("u1" if small else "<u4")))
    return zstandard.compress(data, 3)


def _unpack(pack: bytes, order: int):
    data = zstandard.decompress(pack)
    n, m, wide, count = np.frombuffer(data, "<u4", 4)
    at, out = 16, []
    for size, kind in ((n * order, "<u4"), (n, "<u4"), (m, f"<u{wide}"), (m, f"<u{count}")):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    grams, per_gram, step, times = out
    first = np.cumsum(per_gram) - per_gram
    # Differences start anew at each n-gram.
    run = np.cumsum(step, dtype=np.int64)
    text = run - np.repeat(run[first] - step[first], per_gram)
    return grams.reshape(order, n).T, np.repeat(np.arange(n), per_gram), text, times


def _sums(joined: DataFrame, order: int) -> DataFrame:
    """Rows of documents as they are, and the partial sum of each document in each pack."""
    schema = "run long, number int, doc_id long, lang string, chars long, part double"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.float64()]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        last, model = None, {}
        for batch in batches:
            documents, columns = [], [[] for _ in names]
            for row in batch.to_pylist():
                if row["pack"] is None:
                    documents.append([row[c] for c in names[:5]] + [None])
                    continue
                if row["model"] != last:
                    last = row["model"]
                    model = pickle.loads(zstandard.decompress(last)) if last else {}
                if row["lang"] not in model:
                    continue
                tables, alphabet = model[row["lang"]]
                grams, gram, text, times = _unpack(row["pack"], order)
                values = log_probabilities(tables, alphabet, grams, order)[gram] * times
                at = np.unique(text)
                none = pa.nulls(len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), row["run"])),
                        pa.array(at.astype(np.int32)),
                        *(none.cast(k) for k in kinds[2:5]),
                        pa.array(np.bincount(text, values)[at]),
                    ],
                    names=names,
                )
            columns = list(zip(*documents)) or columns
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return joined.select("run", "number", "doc_id", "lang", "chars", "pack", "model").mapInArrow(run, schema)


def perplexities(docs: DataFrame, trusted_ids: DataFrame, order: int = 4) -> DataFrame:
    """doc_id, lang, chars and perplexity of each row of ``docs`` (doc_id, text, lang); trusted_ids (doc_id) has the texts to learn from."""
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")
    )
    ids = cut_lineage(trusted_ids.where("doc_id is not null").select(F.col("doc_id").alias("trusted_id")).distinct())
    known = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    learned = rows.join(known, rows["doc_id"] == known["trusted_id"], "left_semi")
    counts = cut_lineage(count_grams(learned, order))
    model, shards = model_shards(counts, order)
    salts = -(-task_count(docs.sparkSession) // shards)
    # Documents and packs come from one pass: documents carry shard -1, meet no model, and are told apart after the join.
    salt = F.when(F.col("shard") < 0, F.pmod(F.xxhash64("run", "number"), F.lit(10_007))).otherwise(F.pmod(F.xxhash64("run"), F.lit(salts)))
    packs = packs_of(rows, order, shards).withColumn("salt", salt)
    salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    joined = packs.join(salted, ["shard", "salt"], "left")
    found = _sums(joined, order).groupBy("run", "number").agg(
        F.max("doc_id").alias("doc_id"), F.max("lang").alias("lang"), F.max("chars").alias("chars"), F.sum("part").alias("total")
    )
    return found.select(
        "doc_id",
        F.when(F.col("lang") != NO_LANGUAGE, F.col("lang")).alias("lang"),
        "chars",
        F.exp(-F.col("total") / F.col("chars")).alias("perplexity"),
    )


def judge(
    docs: DataFrame, trusted_ids: DataFrame, order: int = 4, quantile: float = 0.99, aside: int = 5
) -> DataFrame:
    """Adds ``threshold`` (of the language) and ``keep`` to the perplexities; every ``aside``-th trusted id sets thresholds."""
    sets_threshold = F.crc32(F.col("doc_id").cast("string")) % aside == 0
    scored = cut_lineage(perplexities(docs, trusted_ids.where(~sets_threshold), order))
    known = trusted_ids.where(sets_threshold).select(F.col("doc_id").alias("trusted_id")).distinct()
    trusted = scored.join(known, scored["doc_id"] == known["trusted_id"], "left_semi")
    limits = trusted.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    limits = limits.withColumnRenamed("lang", "of_lang")
    joined = scored.join(limits, scored["lang"].eqNullSafe(limits["of_lang"]), "left").drop("of_lang")
    return joined.withColumn("keep", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
