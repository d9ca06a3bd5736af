"""Byte-level BPE through a table of distinct words.

Spark splits the texts into words by the tokenizer's own pattern. Runs of documents, ``RUN_WORDS`` words or one
document each, are written once: a run has its distinct words, numbered, and its documents as word numbers. The distinct
words of all runs meet in shards by their hash, each distinct word in one shard, where it is encoded once; the ids go back
to the runs and join the documents by the words' positions. A run's documents and its words lie in the same bucket of the written
table, so documents are never shuffled, and what is shuffled are packed lists of words and of ids, in zstd frames. A word that a third of all texts repeat is one entry per
run. Decoding joins each batch's distinct ids with the table of pieces, whose size is the vocabulary's.

The pattern's letter and digit classes are completed by asking the tokenizer for its view of the
code points that Java's tables do not know. Added tokens (such as an end-of-text mark) in a text are words of their own, as in the library.
A run holds at least one whole document.

Defined results: a null text counts as empty: no ids, and the empty text when decoded. Rows that repeat are encoded
each. An empty table gives no rows. Ids outside the vocabulary and null ids are left out when decoding, as the
library does; bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinomill.llm.common import task_count
from kinomill.session import scratch_path

RUN_WORDS = 1_000_000
SQUEEZE_LEVEL = 15
WORDS_PER_CALL = 4_096
SHARDS_PER_TASK = 4
ROWS_PER_BATCH, DOCS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 512
LAST_ASSIGNED = 0x40000  # no letters or digits are assigned in the planes beyond
# The white space of the Unicode property White_Space, and the contractions of the byte-level pattern.
SPACE = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The library's tokenizer, without truncation, padding and added marks. One with other steps than byte-level ones is refused."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    split, model = stated["pre_tokenizer"] or {}, stated["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or stated["normalizer"] or model["type"] != "BPE" or model.get("dropout"):
        raise ValueError("only byte-level BPE without normaliser, prefix space and dropout")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in stated["added_tokens"]):
        raise ValueError("added tokens that take in their surroundings are not supported")
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made, [t["content"] for t in stated["added_tokens"]]


def _ranges(points: np.ndarray) -> str:
    """Code points as ranges of a character class."""
    if not len(points):
        return ""
    cuts = np.flatnonzero(np.diff(points) != 1)
    first, last = points[np.append(0, cuts + 1)], points[np.append(cuts, len(points) - 1)]
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in zip(first.tolist(), last.tolist()))


@lru_cache(maxsize=2)
def classes(path: str) -> tuple[str, str]:
    """Letters and digits that only the tokenizer knows. A sign is of a class if it goes on with a word of that class."""
    signs = "".join(chr(c) for c in range(128, LAST_ASSIGNED) if not 0xD800 <= c <= 0xDFFF)
    java = SparkSession.active()._jvm.java.util.regex.Pattern
    unknown = java.compile(r"\P{Cn}+").matcher(signs).replaceAll("")
    split, out = tokenizer(path)[0].pre_tokenizer.pre_tokenize_str, []
    for lead in "a1":
        found = []
        for i in range(0, len(unknown), 4_000):
            # Words that start at the sign itself, place 2 of each three, are not of the lead's class.
            apart = {at for _, (at, _) in split("".join(f"\n{lead}{c}" for c in unknown[i : i + 4_000]))}
            found += [ord(c) for n, c in enumerate(unknown[i : i + 4_000]) if 3 * n + 2 not in apart]
        out.append(_ranges(np.array(found, np.int64)))
    return out[0], out[1]


@lru_cache(maxsize=2)
def word_pattern(path: str) -> str:
    letters, digits = (rf"[\x{{80}}-\x{{10FFFF}}&&[{x}]]" if x else "" for x in classes(path))
    letter, digit = rf"\p{{L}}{letters}", rf"\p{{N}}{digits}"
    return "|".join(CONTRACTIONS) + rf"| ?[{letter}]+| ?[{digit}]+| ?[^{SPACE}{letter}{digit}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def _cut_at(token: str):
    """The text between occurrences of a token, and the token between them."""
    quoted = "".join(rf"\x{{{ord(c):X}}}" for c in token)

    def cut(part: Column) -> Column:
        between = F.split(part, quoted, -1)
        return F.slice(F.flatten(F.transform(between, lambda p: F.array(p, F.lit(token)))), F.lit(1), 2 * F.size(between) - 1)

    return cut


def words(text: Column, path: str) -> Column:
    """The words of a text in order; added tokens between them as words."""
    pattern = F.lit(word_pattern(path))
    parts = F.array(F.coalesce(text, F.lit("")))
    for token in tokenizer(path)[1]:
        parts = F.flatten(F.transform(parts, _cut_at(token)))
    marks = F.array(*[F.lit(t) for t in tokenizer(path)[1]])
    return F.flatten(
        F.transform(parts, lambda p: F.when(F.array_contains(marks, p), F.array(p)).otherwise(F.regexp_extract_all(p, pattern, F.lit(0))))
    )


def _packed(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings, one after the other, and their lengths."""
    ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data and len(text) else np.zeros(0, np.uint8), np.diff(ends)


def squeezed(numbers: np.ndarray, tail: bytes = b"") -> bytes:
    """Numbers of 32 bits, byte by byte of all of them, and a tail as one zstd frame: words and ids are shuffled and written so."""
    planes = np.ascontiguousarray(numbers.astype("<i4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=SQUEEZE_LEVEL).compress(planes.tobytes() + tail)


def unsqueezed(frame: bytes, n: int) -> tuple[np.ndarray, bytes]:
    """The first n numbers of a frame, and the bytes after them."""
    raw = zstandard.ZstdDecompressor().decompress(frame)
    planes = np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").ravel(), raw[4 * n :]


def _run_batch(number: int, docs: list[pa.RecordBatch], kept: list[str], shards: int) -> pa.RecordBatch:
    """Rows of one run: its documents with word numbers, then its distinct words by shard.

    Words are numbered in the order of shard and word, so that a shard's words need no numbers, only that of the first.
    """
    whole = pa.Table.from_batches(docs).combine_chunks()
    column = whole.column("__words").combine_chunks()
    coded = column.flatten().dictionary_encode()
    held, n = coded.dictionary.cast(pa.string()), whole.num_rows
    order = pc.sort_indices(held).to_numpy()
    data, lengths = _packed(held)
    ends, view = np.append(0, np.cumsum(lengths, dtype=np.int64)).tolist(), memoryview(np.ascontiguousarray(data))
    shard = np.fromiter((zlib.crc32(view[a:b]) for a, b in zip(ends, ends[1:])), np.int64, len(held)) % shards
    order = order[np.argsort(shard[order], kind="stable")]
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    codes = pa.ListArray.from_arrays(column.offsets, pa.array(place[coded.indices.to_numpy()]))
    used, first = np.unique(shard[order], return_index=True)
    data, lengths = _packed(held.take(pa.array(order)))
    upto, borders = np.append(0, np.cumsum(lengths, dtype=np.int64)), np.append(first, len(order))
    m = len(used)
    columns = [pa.array(np.full(n + m, number), pa.int64())]
    columns += [pa.concat_arrays([whole.column(c).combine_chunks(), pa.nulls(m, whole.schema.field(c).type)]) for c in kept]
    columns += [
        pa.concat_arrays([codes, pa.nulls(m, codes.type)]),
        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(used, pa.int64())]),
        pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(first, pa.int32())]),
        pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.diff(borders), pa.int32())]),
        pa.array([None] * n + [squeezed(lengths[a:b], data[upto[a] : upto[b]].tobytes()) for a, b in zip(borders[:-1], borders[1:])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["__run", *kept, "__codes", "__shard", "__first", "__size", "__words"])


def _runs(kept: list[str], size: int, shards: int):
    def run(batches):
        number, held, count = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            upto, at = np.cumsum(pc.list_value_length(batch.column("__words")).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while at < batch.num_rows:
                done = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, done + size - count, side="right")))
                # A copy, so that a run's lists start at place 0.
                held.append(batch.take(pa.array(np.arange(at, to))))
                count += int(upto[to - 1]) - done
                at = to
                if count >= size or at < batch.num_rows:
                    yield _run_batch(number, held, kept, shards)
                    number, held, count = number + 1, [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield _run_batch(number, held, kept, shards)

    return run


def _encode_shard(path: str):
    """Ids of the words of one shard, each distinct word encoded once, by run."""

    def run(table: pa.Table) -> pa.Table:
        made = tokenizer(path)[0]
        sizes = table.column("__size").to_numpy()
        lengths, data = zip(*(unsqueezed(frame.as_py(), n) for frame, n in zip(table.column("__words"), sizes.tolist())))
        ends = np.append(0, np.cumsum(np.concatenate(lengths), dtype=np.int64))
        text = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(b"".join(data))).dictionary_encode()
        known, counts = [], []
        for at in range(0, len(text.dictionary), WORDS_PER_CALL):
            for e in made.encode_batch_fast(text.dictionary.slice(at, WORDS_PER_CALL).to_pylist(), add_special_tokens=False):
                known.extend(e.ids)
                counts.append(len(e.ids))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(known, pa.int32()))
        flat, per_word = _take_lists(lists, text.indices.to_numpy().astype(np.int64))
        words_upto = np.append(0, np.cumsum(sizes, dtype=np.int64))
        ids_upto = np.append(0, np.cumsum(per_word))[words_upto]
        found = [
            squeezed(np.concatenate([per_word[a:b], flat[i:j]]))
            for a, b, i, j in zip(words_upto[:-1], words_upto[1:], ids_upto[:-1], ids_upto[1:])
        ]
        return pa.table(
            {
                "__of": table.column("__run"),
                "__first": table.column("__first"),
                "__size": pa.array(sizes, pa.int32()),
                "__total": pa.array(np.diff(ids_upto), pa.int32()),
                "__found": pa.array(found, pa.binary()),
            }
        )

    return run


def _take_lists(lists: pa.ListArray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists at ``places``, one after the other, and their numbers."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(ends)[places]
    upto = np.cumsum(sizes)
    at = np.repeat(ends[:-1][places] - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)
    return lists.values.to_numpy(zero_copy_only=False)[at], sizes


def _join_back(kept: list[str]):
    """Ids of a run's documents from the ids of its words, by position."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        codes = docs.column("__codes").combine_chunks()
        found = found.sort_by("__first").combine_chunks()
        sizes = found.column("__size").to_numpy()
        if not np.array_equal(np.cumsum(sizes) - sizes, found.column("__first").to_numpy()):
            raise ValueError("words of a run are missing or repeated")
        totals = found.column("__total").to_numpy()
        both = [unsqueezed(frame.as_py(), n + m)[0] for frame, n, m in zip(found.column("__found"), sizes.tolist(), totals.tolist())]
        none = [np.zeros(0, np.int32)]
        counts = np.concatenate(none + [x[:n] for x, n in zip(both, sizes)])
        ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
        ids = pa.array(np.concatenate(none + [x[n:] for x, n in zip(both, sizes)]), pa.int32())
        flat, per_word = _take_lists(pa.ListArray.from_arrays(ends, ids), codes.flatten().to_numpy().astype(np.int64))
        upto = np.append(0, np.cumsum(per_word))
        per_doc = upto[np.append(0, np.cumsum(pc.list_value_length(codes).to_numpy(zero_copy_only=False)))]
        lists = pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.array(flat, pa.int32()))
        return docs.select(kept).append_column("ids", lists)

    return run


def encode(docs: DataFrame, keep: list[str] | None = None, path: str | None = None, run_words: int = RUN_WORDS) -> DataFrame:
    """The columns ``keep`` and ``ids`` of each document."""
    path, spark = path or default_path(), docs.sparkSession
    keep = keep or ["doc_id"]
    kept = [f"__k{i}" for i in range(len(keep))]
    split = docs.select(*[docs[c].alias(k) for c, k in zip(keep, kept)], words(docs["text"], path).alias("__words"))
    own = "".join(f"{k} {split.schema[k].dataType.simpleString()}, " for k in kept)
    schema = f"__run long, {own}__codes array<int>, __shard long, __first int, __size int, __words binary"
    tasks, name = task_count(spark), f"bpe_runs_{uuid.uuid4().hex}"
    # Each run goes to one file in one bucket; nothing is shuffled for it. Word lists are long: few rows make a batch.
    before = spark.conf.get(ROWS_PER_BATCH)
    spark.conf.set(ROWS_PER_BATCH, str(DOCS_PER_BATCH))
    try:
        split.mapInArrow(_runs(kept, run_words, SHARDS_PER_TASK * tasks), schema).write.format("parquet").option("compression", "zstd").bucketBy(
            tasks, "__run"
        ).option("path", scratch_path(spark, "bpe")).saveAsTable(name)
    finally:
        spark.conf.set(ROWS_PER_BATCH, before)
    table = spark.table(name)
    spark.sql(f"drop table {name}")  # the name only: the files are not the catalog's
    lists = table.where("__shard is not null").select("__run", "__shard", "__first", "__size", "__words")
    encoded = "__of long, __first int, __size int, __total int, __found binary"
    found = lists.groupBy("__shard").applyInArrow(_encode_shard(path), encoded).repartition(tasks, "__of")
    runs = table.where("__shard is null").select("__run", *kept, "__codes")
    joined = runs.groupBy("__run").cogroup(found.groupBy("__of")).applyInArrow(_join_back(kept), f"{own}ids array<int>")
    return joined.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "ids")


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Table:
    """(id, piece): the bytes of each id."""
    made, added = tokenizer(path)
    known = made.get_vocab(with_added_tokens=True)
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    hidden = [c for c in range(256) if c not in set(shown)]
    # Byte-level pieces show a byte that cannot be printed as the next free sign from U+0100 on.
    byte = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(hidden)}
    rows = sorted((i, p) for p, i in known.items())
    data = [bytes(byte[c] for c in p) if p not in added and all(c in byte for c in p) else p.encode() for _, p in rows]
    return pa.table({"id": pa.array([i for i, _ in rows], pa.int32()), "piece": pa.array(data, pa.binary())})


def _decode(table: pa.Table, column: str, out: str, digest: str | None):
    def run(batches):
        for batch in (b.slice(at, DOCS_PER_BATCH) for b in batches for at in range(0, max(1, b.num_rows), DOCS_PER_BATCH)):
            lists = batch.column(column)
            flat = lists.flatten().cast(pa.int32())
            coded = flat.dictionary_encode()
            known = pa.table({"id": coded.dictionary, "at": pa.array(np.arange(len(coded.dictionary)))})
            met = known.join(table, "id", join_type="left outer", use_threads=False).sort_by("at").column("piece").combine_chunks()
            met = pc.fill_null(met, b"")
            codes = pc.fill_null(coded.indices, len(met))
            met = pa.concat_arrays([met.cast(pa.binary()), pa.array([b""], pa.binary())])
            chosen = met.take(codes)
            ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))
            data, at = chosen.buffers()[2], np.frombuffer(chosen.buffers()[1], np.int32)[chosen.offset : chosen.offset + len(chosen) + 1]
            body = memoryview(data) if data else memoryview(b"")
            borders = at[ends].tolist() if len(chosen) else [0] * len(ends)
            texts = [bytes(body[a:b]).decode("utf-8", "replace") for a, b in zip(borders[:-1], borders[1:])]
            done = batch.append_column(out, pa.array(texts, pa.string()))
            yield done.append_column(digest, ids_digest(lists)) if digest else done

    return run


def ids_digest(ids: pa.Array) -> pa.Array:
    """Hex SHA-256 of the ids as little-endian unsigned 32-bit numbers; none for null lists and lists with a null."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    values = ids.flatten()
    flat = memoryview(pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
    ends = np.append(0, np.cumsum(counts, dtype=np.int64))
    nulls = np.append(0, np.cumsum(values.is_null().to_numpy(zero_copy_only=False)))[ends]
    whole = ids.is_valid().to_numpy(zero_copy_only=False) & (np.diff(nulls) == 0)
    spans = zip((4 * ends[:-1]).tolist(), (4 * ends[1:]).tolist(), whole.tolist())
    return pa.array([hashlib.sha256(flat[a:b]).hexdigest() if all_ else None for a, b, all_ in spans], pa.string())


def decode(encoded: DataFrame, path: str | None = None, column: str = "ids", out: str = "decoded", digest: str | None = None) -> DataFrame:
    """``encoded`` with the text of each row's ids and, if ``digest`` names it, a column with the ids' SHA-256.

    Both are made in one pass, so a task has one Python process for them; the table of pieces comes with the function.
    """
    schema = StructType([*encoded.schema.fields, StructField(out, StringType())])
    if digest:
        schema = schema.add(digest, StringType())
    return encoded.mapInArrow(_decode(pieces(path or default_path()), column, out, digest), schema)
