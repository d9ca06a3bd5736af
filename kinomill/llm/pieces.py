"""SentencePiece encoding and decoding with the n best segmentations.

The pieces of a model file form a lattice over the text. A forward Viterbi pass
gives the best score from the start to each place; these scores are exact
heuristics for an A* search that goes backward from the end, so complete paths
leave its queue in order of their score: ``n_best`` works like that on a lattice.

No piece reaches over the start of a word (it begins with the word mark, which
pieces have only at their start), so the lattice of a text falls apart at words
and its best segmentation joins those of its words. ``encode_batch`` therefore
runs the forward pass once per distinct word of a batch, for all of them side by
side in NumPy, with a backward pass that gives each word's loss when it takes any other
path. The further segmentations of a text change only the words of least loss:
n-1 of them are searched by A* and joined by a second A* over the losses.

The vocabulary files state merge ranks rather than log-probabilities; a piece of rank r counts as
-log(r + 2). Characters without a piece become byte pieces, and so does a literal
word mark, so that decoding gives back the text exactly.

Defined results: null text gives null ids, empty text no ids and one empty segmentation.
Texts are encoded whole; a text that has fewer than n segmentations returns all.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomill.llm.hashing import gather, prefix_sums, span_hashes

MARK = 0x2581  # begins a word inside pieces
LITERAL = 0x110000  # a mark that the text itself holds; no piece has this code
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLOTS = 1 << 20
CHARS_PER_PASS = 1_000_000
PLACES_PER_LATTICE = 50_000  # its arrays have a row per length of a piece; they stay near the processor


@dataclass
class Vocabulary:
    """Pieces of a model file: ids, scores and the bytes they decode to."""

    pieces: list[str]
    first_byte: int  # id of the piece of byte 0
    score: np.ndarray = field(init=False)

    def __post_init__(self):
        n, first = len(self.pieces), self.first_byte
        self.score = -np.log(np.arange(n) + 2.0)
        self.byte_score = float(self.score[-1]) - 1.0  # per byte, below any piece
        self.ids = {p: i for i, p in enumerate(self.pieces) if p and not i < first + 256}
        mark = chr(MARK)
        if any(mark in p.lstrip(mark) for p in self.ids):
            raise ValueError("a piece reaches over the start of a word")
        self.longest = max(map(len, self.ids))
        text = [b""] * first + [bytes([b]) for b in range(256)]
        text += [p.replace(mark, " ").encode() for p in self.pieces[first + 256 :]]
        self.lengths = np.array([len(t) for t in text])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self._index()

    def _index(self):
        """Open hash table from the hash of a piece to its id."""
        self.keys, self.values, self.probes = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -1, np.int32), 1
        for piece, i in self.ids.items():
            codes = np.array([ord(c) for c in piece], np.uint64)
            h = int(span_hashes(prefix_sums(codes), np.array([0]), np.array([len(codes)]))[0])
            at, step = h >> 44, 0
            while self.values[(at + step) % SLOTS] >= 0:
                step += 1
            self.keys[(at + step) % SLOTS], self.values[(at + step) % SLOTS] = h, i
            self.probes = max(self.probes, step + 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes; -1 where there is none."""
        at = (hashes >> np.uint64(44)).astype(np.int64)
        found = np.where(self.keys[at] == hashes, self.values[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.values[at] >= 0))
        for step in range(1, self.probes):
            here = (at[open_] + step) % SLOTS
            hit = self.keys[here] == hashes[open_]
            found[open_[hit]] = self.values[here[hit]]
            open_ = open_[~hit & (self.values[here] >= 0)]
        return found

    def byte_ids(self, code: int) -> list[int]:
        return [self.first_byte + b for b in chr(MARK if code == LITERAL else code).encode("utf-8", "surrogatepass")]


@lru_cache(maxsize=4)
def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary([model.id_to_piece(i) for i in range(model.get_piece_size())], model.piece_to_id("<0x00>"))


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts with marks for spaces and one before each text that is not empty, and the texts' first places."""
    lengths = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    raw = np.where(raw == MARK, LITERAL, np.where(raw == 32, MARK, raw)).astype(np.uint64)
    begins = np.cumsum(lengths) - lengths
    codes = np.insert(raw, begins[lengths > 0], MARK)
    full = lengths + (lengths > 0)
    return codes, np.cumsum(full) - full


def n_best(codes: list[int], n: int, vocabulary: Vocabulary) -> list[tuple[float, list[int]]]:
    """The n best paths of the lattice over ``codes``: (score, ids), best first, ties to smaller ids."""
    size, ids, longest = len(codes), vocabulary.ids, vocabulary.longest
    text = "".join(chr(c) if c != LITERAL else "\x00" for c in codes)
    into: list[list[tuple[int, float, tuple]]] = [[] for _ in range(size + 1)]
    best = [0.0] + [float("-inf")] * size
    for end in range(1, size + 1):
        for start in range(max(0, end - longest), end):
            span = text[start:end]
            i = None if LITERAL in codes[start:end] else ids.get(span)
            if i is not None:
                into[end].append((start, float(vocabulary.score[i]), (i,)))
            elif end - start == 1:
                own = tuple(vocabulary.byte_ids(codes[start]))
                into[end].append((start, vocabulary.byte_score * len(own), own))
        best[end] = max(best[start] + score for start, score, _ in into[end])
    # Backward: a state is a place and the path from there to the end, kept as its first edge and the state behind it. Its
    # bound is the score of its best completion. Of the paths from one place only the n best can belong to the n
    # best of all, so a place is opened n times at most. Ties go to the place nearer to the end, then to smaller
    # ids: of equal paths from one place, the first edge decides, then which of the states behind it was opened first.
    states: list[tuple[tuple[int, ...], int]] = []
    queue, found, opened = [(round(-best[size], 9), -size, (), -1, 0.0)], [], [0] * (size + 1)
    while queue and len(found) < n:
        _, place, piece, behind, score = heapq.heappop(queue)
        place = -place
        if opened[place] == n:
            continue
        opened[place] += 1
        states.append((piece, behind))
        state = len(states) - 1
        if place == 0:
            path = []
            while state >= 0:
                piece, state = states[state]
                path.extend(piece)
            found.append((score, path))
            continue
        for start, own, edge in into[place]:
            if opened[start] < n:
                key = round(-(score + own + best[start]), 9), -start
                heapq.heappush(queue, (*key, edge, state, score + own))
    return found


@dataclass
class Words:
    """Best segmentation of each distinct word and what its second best loses."""

    ids: np.ndarray  # flat
    starts: np.ndarray
    counts: np.ndarray
    score: np.ndarray
    loss: np.ndarray


def _lattice(sums, codes, start, length, vocabulary: Vocabulary):
    """Forward and backward passes over words side by side, longest word first. Returns flat ids and word numbers, scores, losses."""
    n, high = len(start), int(length[0])
    base = np.cumsum(length + 1) - (length + 1)  # place of each word's first node
    places = int(base[-1] + length[-1] + 1)
    word = np.repeat(np.arange(n), length + 1)
    offset = np.arange(places) - base[word]
    source, left = start[word] + offset, length[word] - offset
    wide = min(vocabulary.longest, high)
    edge = np.full((wide + 1, places), -np.inf)
    piece = np.full((wide + 1, places), -1, np.int32)
    for k in range(1, wide + 1):
        at = np.flatnonzero(left >= k)
        found = vocabulary.find(span_hashes(sums, source[at], source[at] + k))
        hit = found >= 0
        edge[k, at[hit]] = vocabulary.score[found[hit]]
        piece[k, at[hit]] = found[hit]
    bare = np.flatnonzero((left >= 1) & (piece[1] < 0))
    code = codes[source[bare]]
    code = np.where(code == LITERAL, MARK, code)
    edge[1, bare] = vocabulary.byte_score * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))

    forward, back = np.full(places, -np.inf), np.zeros(places, np.int64)
    forward[base] = 0.0
    after = np.full(places, -np.inf)
    after[base + length] = 0.0
    active = np.searchsorted(-length, -np.arange(1, high + 1), side="right")  # words of at least that length
    for t in range(1, high + 1):
        here = base[: active[t - 1]] + t
        from_ = here - np.arange(1, min(wide, t) + 1)[:, None]
        scores = forward[from_] + edge[here - from_, from_]
        k = scores.argmax(axis=0)  # the shortest of equally good ones
        forward[here] = scores[k, np.arange(len(here))]
        back[here] = k + 1
    for t in range(1, high + 1):
        here = (base + length)[: active[t - 1]] - t
        k = np.arange(1, min(wide, t) + 1)[:, None]
        after[here] = (edge[k, here] + after[here + k]).max(axis=0)
    total = forward[base + length]

    flat_word, flat_place, flat_ids = [], [], []
    through = edge.copy()
    for k in range(1, wide + 1):
        through[k, : places - k] += forward[: places - k] + after[k:]
        through[k, places - k :] = -np.inf
    node, who = base + length, np.arange(n)
    while len(node):
        k = back[node]
        node = node - k
        through[k, node] = -np.inf
        flat_word.append(who)
        flat_place.append(node)
        flat_ids.append(piece[k, node])
        going = node > base[who]
        node, who = node[going], who[going]
    second = np.maximum.reduceat(through.max(0), base)
    flat_word, flat_place, flat_ids = map(np.concatenate, (flat_word, flat_place, flat_ids))
    order = np.argsort(flat_place, kind="stable")  # places rise from word to word and inside a word
    flat_word, flat_place, flat_ids = flat_word[order], flat_place[order], flat_ids[order]
    missing = np.flatnonzero(flat_ids < 0)
    if len(missing):  # spelled in bytes
        spelled = [vocabulary.byte_ids(int(c)) for c in codes[source[flat_place[missing]]]]
        times = np.ones(len(flat_ids), np.int64)
        times[missing] = [len(x) for x in spelled]
        ends = np.cumsum(times)
        ids = np.repeat(flat_ids, times)
        for i, x in zip(missing, spelled):
            ids[ends[i] - len(x) : ends[i]] = x
        flat_word, flat_ids = np.repeat(flat_word, times), ids
    return flat_ids, np.bincount(flat_word, minlength=n), total, total - second


def segment_words(sums, codes, start, length, vocabulary: Vocabulary) -> Words:
    order = np.argsort(-length, kind="stable")
    parts, at = [], 0
    sizes = np.cumsum(length[order] + 1)
    while at < len(order):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + PLACES_PER_LATTICE, side="right")))
        chosen = order[at:to]
        parts.append(_lattice(sums, codes, start[chosen], length[chosen], vocabulary))
        at = to
    ids = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    starts = np.cumsum(counts) - counts
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    score, loss = (np.concatenate([p[i] for p in parts])[back] for i in (2, 3))
    return Words(ids, starts[back], counts[back], score, loss)


def _joined(n: int, lists: list[list[tuple[float, list[int]]]]) -> list[tuple[float, tuple[int, ...]]]:
    """The n least sums of one loss from each list (rising, first 0): (sum, choices)."""
    queue, seen, out = [(0.0, (0,) * len(lists))], {(0,) * len(lists)}, []
    while queue and len(out) < n:
        loss, choice = heapq.heappop(queue)
        out.append((loss, choice))
        for i, c in enumerate(choice):
            following = choice[:i] + (c + 1,) + choice[i + 1 :]
            if c + 1 < len(lists[i]) and following not in seen:
                seen.add(following)
                heapq.heappush(queue, (loss + lists[i][c + 1][0] - lists[i][c][0], following))
    return out


class Encoder:
    """Encodes batches of texts with one vocabulary; remembers the searched words of recent batches."""

    def __init__(self, path: str = DEFAULT_MODEL, n: int = 3):
        self.vocabulary, self.n = load(path), n
        self.searched = lru_cache(maxsize=200_000)(self._search)

    def _search(self, codes: tuple[int, ...], best: tuple[int, ...]):
        """Losses and ids of a word's n best paths, ``best`` first: among equal scores the queue may begin with another one."""
        paths = n_best(list(codes), self.n, self.vocabulary)
        others = [(paths[0][0] - score, ids) for score, ids in paths if tuple(ids) != best]
        return [(0.0, list(best)), *others][: self.n]

    def encode(self, texts: list[str]):
        """Flat ids, ids per text, score per text, and per text the changes of its further segmentations.

        A change is (score, [(first id to replace, how many, ids instead)]).
        """
        codes, first = codes_of(texts)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), np.zeros(len(texts)), [[] for _ in texts]
        begins = codes == MARK
        begins[1:] &= codes[:-1] != MARK
        begins[first[first < len(codes)]] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.append(start, len(codes)))
        sums = prefix_sums(codes)
        _, sample, inverse = np.unique(span_hashes(sums, start, start + length), return_index=True, return_inverse=True)
        words = segment_words(sums, codes, start[sample], length[sample], self.vocabulary)
        counts = words.counts[inverse]
        ids = words.ids[gather(words.starts[inverse], counts)]
        loss, score = words.loss[inverse], words.score[inverse]
        bounds = np.append(np.searchsorted(start, first), len(start))
        before = np.concatenate([[0], np.cumsum(counts)])
        per_text = before[bounds[1:]] - before[bounds[:-1]]
        scores, others = np.zeros(len(texts)), []
        for i in range(len(texts)):
            low, high = bounds[i], bounds[i + 1]
            scores[i] = score[low:high].sum()
            others.append(self._others(codes, start, length, ids, counts, before, loss, low, high, scores[i]))
        return ids, per_text, scores, others

    def _others(self, codes, start, length, ids, counts, before, loss, low, high, best):
        few = self.n - 1
        here = loss[low:high]
        if not few or not len(here):
            return []
        if len(here) > few:
            bound = np.partition(here, few - 1)[few - 1]
            near = np.flatnonzero(here <= bound)
            near = np.sort(near[np.argsort(here[near], kind="stable")][:few])
        else:
            near = np.arange(len(here))
        near = [low + w for w in near if np.isfinite(loss[low + w])]
        lists = [
            self.searched(tuple(codes[start[w] : start[w] + length[w]].tolist()), tuple(ids[before[w] : before[w] + counts[w]].tolist()))
            for w in near
        ]
        out = []
        for lost, choice in _joined(self.n, lists)[1:]:
            changes = [
                (int(before[w] - before[low]), int(counts[w]), options[c][1]) for w, options, c in zip(near, lists, choice) if c
            ]
            out.append((float(best - lost), changes))
        return out

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> list[str]:
        """The texts of flat ids; the space that stands for the mark before a text goes."""
        lengths = self.vocabulary.lengths[ids]
        data = self.vocabulary.bytes[gather(self.vocabulary.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(per_text)])]
        return [data[a + 1 : b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def segmentations(ids: list[int], others: list) -> list[list[int]]:
    """All segmentations in full, from the best one and the changes of the others."""
    out = [list(ids)]
    for _, changes in others:
        changed = list(ids)
        for at, drop, put in sorted(changes, reverse=True):
            changed[at : at + drop] = put
        out.append(changed)
    return out


ENCODED = (
    "ids array<int>, score double, decoded_equal boolean, "
    "others array<struct<score: double, changes: array<struct<at: int, drop: int, put: array<int>>>>>"
)
_OTHERS = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            ("changes", pa.list_(pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("put", pa.list_(pa.int32()))]))),
        ]
    )
)


def encode(docs: DataFrame, keep: list[str] | None = None, n: int = 3, path: str = DEFAULT_MODEL) -> DataFrame:
    """The columns ``keep`` with ids, score, the further segmentations, and whether decoding gave the text back."""
    kept = docs.select(*(keep or ["doc_id"]), F.col("text").alias("__text"))
    names = [c for c in kept.columns if c != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "__text")

    def run(batches):
        encoder = Encoder(path, n)
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column("__text")), 0).to_numpy(zero_copy_only=False)
            upto, at = np.cumsum(lengths, dtype=np.int64), 0
            while at < batch.num_rows:
                size = max(1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CHARS_PER_PASS)) - at)
                yield _encoded(encoder, batch.slice(at, size), names)
                at += size

    return kept.mapInArrow(run, f"{schema}, {ENCODED}")


def _encoded(encoder: Encoder, batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    texts = batch.column("__text").to_pylist()
    given = [t is not None for t in texts]
    whole = [t or "" for t in texts]
    ids, per_text, scores, others = encoder.encode(whole)
    decoded = encoder.decode(ids, per_text)
    ends = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
    absent = pa.array([not g for g in given])
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)), mask=absent)
    same = [a == b if g else None for a, b, g in zip(whole, decoded, given)]
    changed = [
        [{"score": s, "changes": [{"at": a, "drop": d, "put": p} for a, d, p in c]} for s, c in o] if g else None
        for o, g in zip(others, given)
    ]
    columns = [batch.column(c) for c in names]
    columns += [lists, pa.array(scores, mask=~np.array(given, bool)), pa.array(same, pa.bool_()), pa.array(changed, _OTHERS)]
    return pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "score", "decoded_equal", "others"])
