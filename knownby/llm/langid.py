"""Language identification in two steps: the family, then the language within it.

Features are hashed byte trigrams of the whole lower-cased text, marks and digits read as spaces, square
roots of counts, unit length. A linear support vector machine for each family (against the rest) picks the family; within a
family, one linear machine for each pair of languages votes. The machines are fitted in numpy on a bounded
sample: ``PER_LANGUAGE`` documents of each language, those with the smallest hash of doc_id.

Defined results: null text, or text without a letter, is ``und`` with score 0, as is everything if nothing can be
learned. Languages outside ``FAMILIES`` form a family of their own each. Ties go to the first name in
order. Repeated rows are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import utf8

FAMILIES = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
            "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance"}
#: Training documents of one language, at most.
PER_LANGUAGE = 500
#: The sample is found by counts of 2**CELL_BITS ranges of the hash.
CELL_BITS = 10
DIM_BITS = 12
UND = "und"
_LETTER = regex.compile(r"\p{L}")
_PLAIN = bytes(i if i >= 128 or 97 <= i <= 122 else 32 for i in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def features(text: str | None) -> np.ndarray:
    """Unit vector of square-rooted trigram counts, 2**DIM_BITS wide."""
    words = b" ".join(utf8(text).lower().translate(_PLAIN).split())
    b = np.frombuffer(b" " + words + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(1 << DIM_BITS, np.float32)
    code = (b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(2654435761)
    counts = np.sqrt(np.bincount(code >> np.uint32(32 - DIM_BITS), minlength=1 << DIM_BITS)).astype(np.float32)
    return counts / np.linalg.norm(counts)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, steps: int = 200) -> np.ndarray:
    """Weights and bias of a squared-hinge machine, y in {-1, 1}; accelerated full gradients, classes balanced."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    rate = 1 / (1 + 2 * c * 2)  # rows have length sqrt(2), weights sum to 1
    w = np.zeros(x1.shape[1])
    ahead, t = w, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ ahead))
        new = ahead - rate * (ahead - 2 * c * (share * slack * y) @ x1)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


@dataclass
class LanguageModel:
    """Family machines (one row each) and, by family, its languages and its pairs' machines."""

    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, (1 << DIM_BITS) + 1)))
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UND, 0.0
        x = np.append(features(text), 1.0)
        margins = self.family_weights @ x
        family = self.families[int(margins.argmax())]
        score = 1 / (1 + np.exp(-3 * margins.max())) if len(self.families) > 1 else 1.0
        names = self.languages[family]
        if len(names) == 1:
            return names[0], float(score)
        votes, weight = np.zeros(len(names)), np.zeros(len(names))
        for (i, j), m in zip(self.pairs[family], self.pair_weights[family] @ x):
            votes[i if m >= 0 else j] += 1
            weight[i] += m
            weight[j] -= m
        best = max(range(len(names)), key=lambda i: (votes[i], weight[i], -i))
        return names[best], float(score / (1 + np.exp(-3 * weight[best] / (len(names) - 1))))


def fit(x: np.ndarray, langs: list[str], families: Mapping[str, str]) -> LanguageModel:
    langs = np.array(langs, object)
    of = np.array([families.get(v, v) for v in langs], object)
    model = LanguageModel(sorted(set(of)))
    if len(model.families) > 1:
        model.family_weights = np.array([linear_svm(x, np.where(of == f, 1, -1)) for f in model.families])
    else:
        model.family_weights = np.zeros((len(model.families), x.shape[1] + 1))
    for f in model.families:
        names = model.languages[f] = sorted(set(langs[of == f]))
        model.pairs[f] = list(combinations(range(len(names)), 2))
        fits = []
        for i, j in model.pairs[f]:
            here = (langs == names[i]) | (langs == names[j])
            fits.append(linear_svm(x[here], np.where(langs[here] == names[i], 1, -1)))
        model.pair_weights[f] = np.array(fits)
    return model


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, families: Mapping[str, str] = FAMILIES) -> LanguageModel:
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    # Counts of hash ranges tell which ranges the smallest hashes lie in; only these rows meet by language.
    ids = known.select("doc_id", "lang").distinct().withColumn("cell", F.expr(f"shiftright(xxhash64(doc_id), {64 - CELL_BITS})"))
    held = ids.groupBy("lang", "cell").agg(F.count("*").alias("n")) \
        .withColumn("upto", F.expr("sum(n) OVER (PARTITION BY lang ORDER BY cell ROWS UNBOUNDED PRECEDING)"))
    near = ids.join(held.where(F.col("upto") - F.col("n") < per_language).select("lang", "cell"), ["lang", "cell"], "left_semi")
    first = "row_number() OVER (PARTITION BY lang ORDER BY xxhash64(doc_id), doc_id)"
    chosen = near.withColumn("n", F.expr(first)).where(f"n <= {per_language}") \
        .select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    rows = known.select("doc_id", "lang", "text").join(
        F.broadcast(chosen), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))  # PER_LANGUAGE of each

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [has_letter(t) for t in batch["text"].to_pylist()]
            batch = batch.filter(pa.array(keep, pa.bool_()))
            x = [features(t).astype(np.float16).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], pa.array(x, pa.binary())], ["doc_id", "lang", "x"])

    got = rows.select("doc_id", "lang", "text").mapInArrow(featurise, "doc_id long, lang string, x binary").toPandas()
    got["order"] = [xxhash.xxh3_64_intdigest(x) for x in got["x"]]  # a fixed order also among repeated rows
    got = got.sort_values(["lang", "doc_id", "order"])
    if not len(got):
        return LanguageModel()
    x = np.frombuffer(b"".join(bytes(v) for v in got["x"]), np.float16).reshape(len(got), -1).astype(np.float32)
    return fit(x, list(got["lang"]), families)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight row for each family and pair

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out().alias("held_out"), "text") \
        .mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double")
