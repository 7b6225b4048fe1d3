"""Language identification from character n-grams.

Sparse multinomial logistic regression on TF-IDF weights of hashed 1- to
3-grams, trained by follow-the-regularised-leader with elastic-net penalties,
and a temperature fitted on documents that training has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import MIX_A, mix

PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double"
UNDETERMINED = "und"

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def gram_counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, count) of the hashed character 1- to 3-grams of a whole text.

    Lower-cased; runs of anything but letters count as one space, with one
    before and after the text.  No letters: no features.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0)
    points = np.concatenate([[32], np.where(letter, points, 32), [32]]).astype(np.uint64)
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    two = points[:-1] << np.uint64(21) | points[1:]
    three = two[:-1] << np.uint64(21) | points[2:]
    grams = np.concatenate([points[points != 32], two, three])
    sizes = np.concatenate([(points[points != 32] * 0 + 1), two * 0 + 2, three * 0 + 3])
    feature = (mix(grams + sizes * MIX_A) >> np.uint64(64 - bits)).astype(np.int64)
    count = np.bincount(feature, minlength=1 << bits)
    found = np.flatnonzero(count)
    return found, count[found].astype(float)


def tfidf(found: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights (1 + log tf) * idf of unit length."""
    weight = (1 + np.log(count)) * idf[found]
    return weight / max(np.sqrt(weight @ weight), 1e-12)


@dataclass
class FtrlSoftmax:
    """Per-coordinate FTRL-proximal for softmax regression; weights are sparse by the L1 part."""

    features: int
    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5

    def __post_init__(self) -> None:
        self.z = np.zeros((self.features + 1, self.classes))
        self.n = np.zeros((self.features + 1, self.classes))

    def weights(self, rows: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, found: np.ndarray, weight: np.ndarray, label: int) -> None:
        rows, x = np.append(found, self.features), np.append(weight, 1.0)  # the last is the bias
        w = self.weights(rows)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[rows]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[rows] += g - sigma * w
        self.n[rows] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden-section search over its logarithm."""

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # float32, features + bias by language
    idf: np.ndarray
    temperature: float
    bits: int

    def predict(self, text: str | None) -> tuple[str, float]:
        found, count = gram_counts(text or "", self.bits)
        if not len(found) or not self.languages:
            return UNDETERMINED, 0.0
        logits = tfidf(found, count, self.idf) @ self.weights[found] + self.weights[-1]
        p = softmax(logits.astype(float) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def document_frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Documents that have each feature, over all rows; the driver gets 2**bits sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found, _ = gram_counts(text.as_py() or "", bits)
                total[found] += 1
                rows += len(found) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], names=["feature", "n"]
        )

    sums = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << bits)
    real = sums[sums.feature >= 0]
    df[real.feature.to_numpy()] = real.n.to_numpy()
    return df, int(sums.n[sums.feature < 0].sum())


def train(
    docs: DataFrame,
    may_learn: Column,
    *,
    per_language: int = 400,
    calibration_share: float = 0.2,
    epochs: int = 3,
    bits: int = 16,
) -> LanguageModel:
    """Fit on at most ``per_language`` rows of each language, chosen by a hash of the id.

    IDF counts cover every learnable row.  A fifth of the sample is kept from
    training and sets the temperature.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
        docs["lang"].cast("string").alias("lang"),
    ).filter(may_learn & F.col("lang").isNotNull())
    df, n = document_frequencies(rows.select("text"), bits)
    idf = np.log((1 + n) / (1 + df)) + 1
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    sample = []
    for language in languages:
        ids = rows.filter(F.col("lang") == language).select("doc_id")
        wanted = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_language).collect()]
        sample += [(i, language) for i in wanted if i is not None]
    order = {i: k for k, i in enumerate(dict.fromkeys(i for i, _ in sample))}
    if not order:
        return LanguageModel([], np.zeros((1, 0), np.float32), idf, 1.0, bits)

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram_counts(t.as_py() or "", bits) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([f.astype(np.int32) for f, _ in grams], pa.list_(pa.int32())),
                    pa.array([c.astype(np.float32) for _, c in grams], pa.list_(pa.float32())),
                ],
                names=["doc_id", "lang", "found", "count"],
            )

    chosen = rows.filter(F.col("doc_id").isin(list(order)))
    features = chosen.mapInArrow(featurize, "doc_id long, lang string, found array<int>, count array<float>")
    data = []
    for r in features.toArrow().to_pandas().sort_values(["doc_id", "lang"]).itertuples():
        found = np.asarray(r.found, np.int64)
        if len(found):
            weight = tfidf(found, np.asarray(r.count, float), idf)
            data.append((order[r.doc_id], found, weight, languages.index(r.lang)))
    data.sort(key=lambda d: (d[0], d[3]))
    rng = np.random.default_rng(11)
    rng.shuffle(data)
    kept = data[int(len(data) * calibration_share) :]
    model = FtrlSoftmax(1 << bits, len(languages))
    for _ in range(epochs):
        for i in rng.permutation(len(kept)):
            model.learn(*kept[i][1:])
    weights = model.weights(slice(None))
    held = data[: len(data) - len(kept)]
    temperature = 1.0
    if held:
        logits = np.array([w @ weights[f] + weights[-1] for _, f, w, _ in held])
        temperature = fit_temperature(logits, np.array([label for *_, label in held]))
    return LanguageModel(languages, weights.astype(np.float32), idf, temperature, bits)


def identify(docs: DataFrame, model: LanguageModel, held_out: Column) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row, from the whole text alone.

    Null texts and texts without letters are ``und`` with score 0, as is
    everything if no labelled row could be learned from.  Null ids and repeated
    rows are predicted like others; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), held_out.alias("held_out"), docs["text"].cast("string").alias("text")
    )
    return rows.mapInArrow(run, PREDICTIONS)


def id_remainder(docs: DataFrame, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; 0 for null ids."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % modulus, F.lit(0))


def identify_languages(docs: DataFrame, *, modulus: int = 3, held_remainder: int = 1, **options: int) -> DataFrame:
    """Train on the rows whose ``id_remainder`` is another one and predict all rows."""
    held_out = id_remainder(docs, modulus) == held_remainder
    model = train(docs.filter(~held_out), F.lit(True), **options)
    return identify(docs, model, held_out)
