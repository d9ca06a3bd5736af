"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are character 1- to 3-grams of the lower-cased text, hashed to a fixed
number of columns, weighted by (1 + log count) x inverse document frequency and
scaled to length one. Document frequencies come from all training documents:
each task adds up its documents in one array of fixed length and sends the
columns that occur, which are summed by a group-by. The weights are trained with
follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties) on a
bounded, hash-chosen sample per language (``sample`` documents altogether, whole
texts), in one task; a part of the sample that training leaves out sets the
temperature of the probabilities. The model has a fixed number of columns per
language, so it travels with the tasks that predict.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as
is every text when nothing could be learned. Documents with null language are
not learned from. Ids may repeat or be null; each row gets its prediction. Long texts
are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


WIDTH = 1 << 16  # columns
ORDERS = (1, 2, 3)
LETTER = regex.compile(r"\p{L}")
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
UNKNOWN = "und"


def columns_of(text: str) -> np.ndarray:
    """Column of each n-gram occurrence of the lower-cased text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for n in ORDERS:
        if len(codes) >= n:
            mixed = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                mixed = (mixed ^ codes[i : len(codes) - n + 1 + i]) * MIX[i]
            found.append(mixed >> np.uint64(64 - 16))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and their weights, of length one."""
    counts = np.bincount(columns_of(text), minlength=WIDTH)
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / max(1e-12, np.sqrt((values * values).sum()))


@dataclass
class Follower:
    """Follow-the-regularised-leader for a softmax over sparse rows."""

    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-3

    def __post_init__(self):
        self.z, self.n = np.zeros((2, WIDTH + 1, self.classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at, values, label: int) -> None:
        w = self.weights(at)
        p = softmax(values @ w)
        p[label] -= 1
        g = values[:, None] * p
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _with_bias(at, values):
    return np.append(at, WIDTH), np.append(values, 1.0)


def fit(rows: list[tuple[str, int, bool]], idf: np.ndarray, classes: int, epochs: int) -> tuple[np.ndarray, float]:
    """Weights (columns and bias) and temperature from (text, label, for calibration)."""
    model = Follower(classes)
    ready = [(*_with_bias(*features(text, idf)), label, late) for text, label, late in rows]
    order = np.random.default_rng(1).permuted(np.tile(np.arange(len(ready)), (epochs, 1)), axis=1)
    for i in order.ravel():
        at, values, label, late = ready[i]
        if not late:
            model.learn(at, values, label)
    weights = model.weights(slice(None))
    held = [(values @ weights[at], label) for at, values, label, late in ready if late]
    if not held:
        return weights, 1.0
    raw, labels = np.array([x for x, _ in held]), np.array([y for _, y in held])

    def loss(t):
        return -np.log(softmax(raw / t)[np.arange(len(labels)), labels] + 1e-12).mean()

    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    return weights, float(min(grid, key=loss))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray | None
    weights: np.ndarray | None
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        at, values = _with_bias(*features(text, self.idf))
        p = softmax(values @ self.weights[at] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _frequencies(docs: DataFrame) -> DataFrame:
    """(at, n): documents with the column, of all ``docs`` (text)."""

    def count(batches):
        total, seen = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, bool)
        for batch in batches:
            for text in batch.column("text"):
                at = columns_of(text.as_py())
                seen[at] = True
                total += seen
                seen[at] = False
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    return docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = 6_000, epochs: int = 3) -> Model:
    """Learn from ``docs`` (doc_id, text, lang); ``sample`` bounds the documents the weights are fitted on.

    The rows of the sample are those of each language with the smallest hashes,
    in equal shares; counts and document frequencies use every document.
    """
    known = docs.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], None, None)
    share = max(20, sample // len(languages))
    n = sum(sizes.values())
    idf = np.ones(WIDTH)
    seen = _frequencies(known).collect()  # at most WIDTH rows
    idf[:] = np.log(1 + n)
    for row in seen:
        idf[row["at"]] = np.log((1 + n) / (1 + row["n"])) + 0.1
    # Hash bound that keeps about ``share`` documents of the language.
    bound = F.lit(0.0)
    for language in languages:
        bound = F.when(F.col("lang") == language, min(1.0, share / sizes[language])).otherwise(bound)
    part = F.pmod("h", F.lit(1 << 40)).cast("double") / float(1 << 40)
    drawn = known.where(part < bound).select("text", "lang", "h")
    labels = {language: i for i, language in enumerate(languages)}

    def learn(batches):
        rows = [
            (r["h"], r["text"], labels[r["lang"]], r["h"] // 7 % 5 == 0) for batch in batches for r in batch.to_pylist()
        ]
        rows.sort()
        weights, temperature = fit([r[1:] for r in rows], idf, len(languages), epochs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([temperature])],
            names=["weights", "temperature"],
        )

    fitted = drawn.repartition(1).mapInArrow(learn, "weights binary, temperature double").first()
    weights = np.frombuffer(fitted["weights"], np.float32).reshape(WIDTH + 1, len(languages))
    return Model(languages, idf, weights, fitted["temperature"])


def predict(
    docs: DataFrame, model: Model, keep: list[str | Column] | None = None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the prediction under ``names``; only the text is an input."""
    kept = docs.select(*(keep or ["doc_id"]))
    own = kept.columns
    source = "text" if "text" in own else "__text"
    if source not in own:
        kept = docs.select(*(keep or ["doc_id"]), F.col("text").alias(source))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in own)

    def run(batches):
        for batch in batches:
            pairs = [model.predict(text.as_py()) for text in batch.column(source)]
            columns = [batch.column(c) for c in own]
            columns += [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, *names])

    return kept.mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def held_out(doc_id: Column) -> Column:
    """Every fourth document, by a checksum of its id, is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
