"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

* Every word falls into two bins, by its lower-cased text and by its shape (runs of letters, digits and marks).
  A bin has a fixed sparse ternary index vector, drawn from a seed. Its context vector is the sum of the index
  vectors of all words up to two places away, over all documents: integer sums, so their order is of no
  account. Tasks add up what they read and send one row for each bin, so the table's size is fixed.
* A document is pooled into mean and deviation of its words' context vectors of both kinds.
* A two-layer numpy network is fitted on a bounded sample of labelled rows (``SAMPLE``; those with the smallest
  hash of their doc_id). A part of the sample is held back to fit the temperature that calibrates it.

Defined results: null and empty texts pool to zeros and get a score like any other; without usable labels the
score is 0.5, with one class only the smoothed share of that class. Labels given twice for a doc_id count
with the smaller one. Extra columns are ignored. Rows repeat as they came.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import TEXT_ROWS, small_batches, text_batches, utf8

LEX, SHAPES, DIM, NONZERO, REACH = 8_192, 4_096, 32, 4, 2
BINS = LEX + SHAPES
#: Labelled documents the network is fitted on, at most.
SAMPLE = 4_000
THRESHOLD = 0.3
FEATURES = 4 * DIM + 1
_CHUNK = 200_000
_CLASSES = bytes(b"A"[0] if 65 <= i <= 90 else b"a"[0] if 97 <= i <= 122 or i >= 128 else b"0"[0] if 48 <= i <= 57
                 else i for i in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def index_vectors() -> np.ndarray:
    """BINS + 1 ternary rows with NONZERO entries; the last one, for the gap between documents, is zero."""
    rng = np.random.default_rng(19)
    out = np.zeros((BINS + 1, DIM), np.int8)
    for row in out[:-1]:
        row[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


class Bins(dict):
    """Word bytes to its bins, packed as lexical bin + shape bin * 2**16."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        shape = _RUNS.sub(rb"\1\1", word.translate(_CLASSES))[:16].replace(b"aa", b"a").replace(b"AA", b"A")
        lex = xxhash.xxh3_64_intdigest(word.lower()) % LEX
        value = self[word] = lex + ((LEX + xxhash.xxh3_64_intdigest(shape) % SHAPES) << 16)
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = utf8(text).split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins, index, total = Bins(), index_vectors(), np.zeros((BINS, DIM), np.int64)
    gap = np.full(REACH, BINS + (BINS << 16), np.int64)

    def add(parts: list[np.ndarray]) -> None:
        packed = np.concatenate(parts)
        lex, shape = packed & 0xFFFF, packed >> 16
        own = index[lex] + index[shape]
        around = np.zeros_like(own)
        for k in range(1, REACH + 1):
            around[k:] += own[:-k]
            around[:-k] += own[k:]
        for kind in (lex, shape):
            order = np.argsort(kind.astype(np.uint16), kind="stable")
            ordered = kind[order]
            start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            sums = np.add.reduceat(around[order], start, axis=0, dtype=np.int64)
            real = ordered[start] < BINS
            total[ordered[start][real]] += sums[real]

    parts, held = [gap], 0
    for batch in batches:
        for text in batch["text"].to_pylist():
            words = bins.of(text)
            for i in range(0, len(words), _CHUNK):
                parts += [words[i:i + _CHUNK]]
                held += len(parts[-1])
                if held >= _CHUNK:  # a very long text continues with its last words as neighbours
                    add(parts)
                    parts, held = [gap], 0
            parts.append(gap)
    add(parts)
    some = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(total[some, i]) for i in range(DIM))],
                                     ["bin", *(f"v{i}" for i in range(DIM))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vector of every bin, from all documents: a table of BINS rows whatever their number."""
    schema = "bin long, " + ", ".join(f"v{i} long" for i in range(DIM))
    with text_batches(docs.sparkSession):
        sums = docs.select("text").mapInArrow(_context_sums, schema).groupBy("bin").agg(
            *(F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM))).toPandas()
    out = np.zeros((BINS, DIM), np.float32)
    values = sums.drop(columns="bin").to_numpy(np.float64)
    out[sums["bin"].to_numpy(np.int64)] = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)
    return out


def pooled(texts: list[str | None], vectors: np.ndarray, bins: Bins) -> np.ndarray:
    """Mean and deviation of the word vectors of both kinds; and whether there is any word."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        words = bins.of(text)
        if len(words):
            row = []
            for kind in (words & 0xFFFF, words >> 16):
                used, counts = np.unique(kind, return_counts=True)
                v, w = vectors[used], (counts / len(words)).astype(np.float32)
                mean = w @ v
                row += [mean, np.sqrt(np.maximum(w @ (v * v) - mean * mean, 0))]
            out[i, :-1] = np.concatenate(row)
            out[i, -1] = 1
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden tanh layer, one logit, divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _constant(share: float) -> Network:
    zero = np.zeros(FEATURES)
    return Network(zero, zero + 1, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 400, seed: int = 3) -> Network:
    """Adam on the log loss; every fifth row is held back for the temperature."""
    if len(set(y)) < 2:
        return _constant((y.sum() + 1) / (len(y) + 2) if len(y) else 0.5)
    x, y = x.astype(np.float64), y.astype(np.float64)
    back = np.arange(len(y)) % 5 == 4
    if len(set(y[~back])) < 2:
        back[:] = False
    rng = np.random.default_rng(seed)
    net = Network(x[~back].mean(0), x[~back].std(0) + 1e-3, rng.normal(0, 0.1, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, 0.1, hidden), 0.0)
    z, t = (x[~back] - net.mean) / net.scale, y[~back]
    state = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    for step in range(1, epochs + 1):
        w1, b1, w2, b2 = state
        h = np.tanh(z @ w1 + b1)
        error = (1 / (1 + np.exp(-(h @ w2 + b2))) - t) / len(t)
        back_h = np.outer(error, w2) * (1 - h * h)
        grads = [z.T @ back_h + 1e-3 * w1, back_h.sum(0), h.T @ error + 1e-3 * w2, np.array([error.sum()])]
        for p, g, m, v in zip(state, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(state[3][0])
    if back.any():
        logit, held = net.logits(x[back]), y[back]
        losses = {t: np.mean(np.logaddexp(0, -np.where(held > 0, 1, -1) * logit / t)) for t in np.geomspace(0.25, 8, 61)}
        net.temperature = float(min(losses, key=losses.get))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scores(self, texts: pa.Array, bins: Bins) -> np.ndarray:
        """Scores of a batch's texts, of which some at a time become Python strings."""
        parts = (texts.slice(i, TEXT_ROWS).to_pylist() for i in range(0, len(texts), TEXT_ROWS))
        return np.concatenate([np.zeros(0), *(self.network.probability(pooled(p, self.vectors, bins)) for p in parts)])


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Vectors from all documents; the network from at most ``sample`` labelled rows outside the held-out fold."""
    vectors = word_vectors(docs)
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality")) \
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) \
        .select(F.col("doc_id").alias("__id"), "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))  # SAMPLE rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins()
        for batch in batches:
            x = pooled(batch["text"].to_pylist(), vectors, bins)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], pa.array(list(x), pa.list_(pa.float32()))],
                                             ["doc_id", "quality", "x"])

    with text_batches(docs.sparkSession):
        got = rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "text") \
            .mapInArrow(features, "doc_id long, quality int, x array<float>").toPandas()
    got["order"] = [xxhash.xxh3_64_intdigest(str(i)) for i in got["doc_id"]]
    got["first"] = [tuple(x[:4]) for x in got["x"]]  # a fixed order also among repeated rows
    got = got.sort_values(["order", "first"])
    x = np.array(got["x"].tolist(), np.float32).reshape(len(got), FEATURES)
    return QualityModel(vectors, fit(x, got["quality"].to_numpy(np.int64)))


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BINS x DIM floats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins()
        for batch in batches:
            s = shared.value.scores(batch["text"], bins)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(s, pa.float64()),
                                              pa.array((s >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text") \
        .mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents the model does not reject, with all their columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins()
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch["text"], bins) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
