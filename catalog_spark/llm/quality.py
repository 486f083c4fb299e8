"""Quality of a text from random-indexing word vectors, pooled, under a two-layer network with calibrated probabilities.

Every word owns a fixed sparse index vector; its word vector is the sum of the index vectors of its neighbours over all
documents.  Words live in a fixed number of slots by their hash, so the vectors have one size whatever the vocabulary, and
tasks add them up in small blocks of slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .text import bounded_sample, chunks, flat_bytes, hashed, spans

SLOTS = 1 << 14
WIDTH = 32
REACH = 2  # neighbours on either side
BLOCK = 16  # slots that travel together
CHUNK_BYTES = 1 << 20
SAMPLE_TEXTS = 20_000  # labelled texts the network is fitted on
HIDDEN = 32


@dataclass
class QualityModel:
    layers: list[np.ndarray]  # weights and biases of both layers
    mean: np.ndarray
    scale: np.ndarray
    temperature: float


def index_places(seed: int = 3) -> np.ndarray:
    """(SLOTS, 2): where the index vector of a slot holds its +1 and its -1."""
    rng = np.random.default_rng(seed)
    plus = rng.integers(0, WIDTH, SLOTS)
    return np.stack([plus, (plus + rng.integers(1, WIDTH, SLOTS)) % WIDTH], axis=1)


def _slots(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of the words of texts in order; a stretch of symbols is a word of its own."""
    owner, at, to = spans(data, start, end, symbols=True)
    return owner, (hashed(data, at, to) % np.uint64(SLOTS)).astype(np.int64)


def context_counts(owner: np.ndarray, slot: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(SLOTS, WIDTH) sums of the neighbours' index vectors."""
    sums = np.zeros(SLOTS * WIDTH, np.int64)
    for reach in range(1, REACH + 1):
        same = owner[reach:] == owner[:-reach]
        a, b = slot[:-reach][same], slot[reach:][same]
        for word, other in ((a, b), (b, a)):
            sums += np.bincount(word * WIDTH + places[other, 0], minlength=len(sums))
            sums -= np.bincount(word * WIDTH + places[other, 1], minlength=len(sums))
    return sums.reshape(SLOTS, WIDTH)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(SLOTS, WIDTH) unit vectors from the neighbours of all words of all documents, their common direction taken out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, sums = index_places(), np.zeros((SLOTS, WIDTH), np.int64)
        for batch in batches:
            data, start, end = flat_bytes(batch.column(0))
            for part in chunks(start, end, CHUNK_BYTES):
                sums += context_counts(*_slots(data, start[part], end[part]), places)
        full = np.flatnonzero(sums.reshape(-1, BLOCK * WIDTH).any(axis=1))
        packed = [sums[b * BLOCK : (b + 1) * BLOCK].reshape(-1) for b in full]
        # by byte place, and the sign in the lowest bit: small numbers leave most places zero
        packed = [((p << 1) ^ (p >> 63)).view(np.uint8).reshape(-1, 8).T.tobytes() for p in packed]
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                z = np.ascontiguousarray(np.frombuffer(packed.as_py(), np.uint8).reshape(8, -1).T).view(np.int64).reshape(-1)
                held[block] = held.get(block, 0) + ((z >> 1) ^ -(z & 1))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["block", "sums"])

    kind = "block int, sums binary"
    rows = docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t")).mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).collect()
    vectors = np.zeros((SLOTS // BLOCK, BLOCK * WIDTH))
    for r in rows:  # SLOTS x WIDTH numbers, whatever the documents
        vectors[r["block"]] = np.frombuffer(r["sums"], np.int64)
    vectors = vectors.reshape(SLOTS, WIDTH)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)
    seen = size[:, 0] > 0
    if seen.any():
        unit[seen] -= unit[seen].mean(axis=0)
    return unit.astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features): mean and spread of the word vectors of every text; zeros without words."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = sent.value
        for batch in batches:
            data, start, end = flat_bytes(batch.column(1))
            for part in chunks(start, end, CHUNK_BYTES):
                n = part.stop - part.start
                owner, slot = _slots(data, start[part], end[part])
                found = np.zeros((n, 2 * WIDTH), np.float32)
                if len(owner):
                    first = np.flatnonzero(np.diff(np.r_[-1, owner]))
                    size = np.diff(np.r_[first, len(owner)])[:, None]
                    x = vectors[slot]
                    mean = np.add.reduceat(x, first, axis=0) / size
                    spread = np.sqrt(np.maximum(0, np.add.reduceat(x * x, first, axis=0) / size - mean * mean))
                    found[owner[first]] = np.concatenate([mean, spread], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 2 * WIDTH), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, n), lists], ["doc_id", "features"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
    return rows.mapInArrow(run, "doc_id long, features array<float>")


def _logits(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(0, x @ w1 + b1)
    return hidden, hidden @ w2[:, 0] + b2[0]


def train(x: np.ndarray, y: np.ndarray, rounds: int = 40, batch: int = 256, seed: int = 9) -> QualityModel:
    """Two layers by Adam on four fifths of the rows; the temperature is the one that suits the last fifth best."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    fit, rest = order[len(x) // 5 :], order[: len(x) // 5]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    z = (x - mean) / scale
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(rounds):
        own = rng.permutation(fit)
        for i in range(0, len(own), batch):
            rows, step = own[i : i + batch], step + 1
            hidden, logit = _logits(layers, z[rows])
            g = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y[rows])[:, None] / len(rows)
            back = (g @ layers[2].T) * (hidden > 0)
            grads = [z[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ g + 1e-4 * layers[2], g.sum(axis=0)]
            for w, d, m, v in zip(layers, grads, first, second):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    held = rest if len(rest) else fit
    _, logit = _logits(layers, z[held])
    temperatures = np.exp(np.linspace(-1.5, 2.0, 71))
    losses = [np.logaddexp(0, np.where(y[held] > 0, -1, 1) * logit / t).mean() for t in temperatures]
    return QualityModel(layers, mean, scale, float(temperatures[int(np.argmin(losses))]))


def fit(features: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> QualityModel | None:
    """Fit on at most about ``sample`` rows of ``labels`` (doc_id, quality); None without both classes."""
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").dropDuplicates(["doc_id"])
    chosen = bounded_sample(chosen.withColumn("all", F.lit(1)), "all", sample, F.col("doc_id"))
    got = sorted((r["doc_id"], r["y"], r["features"]) for r in features.join(F.broadcast(chosen.drop("all")), "doc_id").collect())
    if len({y for _, y, _ in got}) < 2:
        return None
    return train(np.array([f for _, _, f in got], float), np.array([y for _, y, _ in got], float))


def score(features: DataFrame, model: QualityModel | None) -> DataFrame:
    """(doc_id, score): the calibrated probability of quality; 0.5 if there is no model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.full(batch.num_rows, 0.5)
            if model is not None and batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                _, logit = _logits(model.layers, (x - model.mean) / model.scale)
                p = 1 / (1 + np.exp(-np.clip(logit / model.temperature, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_TEXTS) -> DataFrame:
    """(doc_id, score) for every row of ``docs``, learnt from ``labels`` (doc_id, quality).

    Word vectors come from all documents.  A null text counts as empty; a text without words has a score like any other,
    from features that are all zero.  Rows with a null doc_id are scored too, repeated rows each.  An empty table gives an
    empty result; other columns are not looked at.
    """
    features = materialize(pooled(docs, word_vectors(docs, text), doc_id, text), "features")
    return score(features, fit(features, labels, sample))
