"""Toxicity of a text from subword bags: the embeddings of a word's character n-grams are averaged into a linear softmax.

A text is as toxic as its most toxic word, so a few words in a long text are not averaged away.  Embeddings and softmax
are trained together on labelled texts only; which words are to blame is found by the training, with an attention over
the words of a text that sharpens from their mean to their maximum.  A misspelt word that was never seen shares most of
its n-grams, and so its score, with the word it comes from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import bounded_sample, chunks, flat_bytes, hashed, lower, spans

BUCKETS = 1 << 17
WIDTH = 8
GRAMS = (3, 4, 5, 6)
SAMPLE_TEXTS = 1500  # labelled texts a class
SAMPLE_BYTES = 20_000  # training texts are no longer; scored texts may be
CHUNK_BYTES = 1 << 20
ROUNDS = 120


@dataclass
class ToxicityModel:
    bucket_score: np.ndarray  # by n-gram bucket: embedding times the difference of the softmax weights
    bias: float
    slope: float  # of the calibrated logit
    shift: float


def words_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, word) pairs of texts in order, and (from, to) of the different words in lower case."""
    owner, at, to = spans(data, start, end, symbols=True)
    low, high = (int(at[0]), int(to[-1])) if len(at) else (0, 0)
    own = data[low:high]  # the texts may be few of a large batch
    letters = np.r_[0, np.cumsum((own >= 128) | ((own | 32) >= 97) & ((own | 32) <= 122))]
    word = letters[to - low] > letters[at - low]  # numbers and symbols say nothing
    owner, at, to = owner[word], at[word], to[word]
    _, first, which = np.unique(hashed(data, at, to, fold=True), return_index=True, return_inverse=True)
    return owner, which, at[first], to[first]


def bags(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of all n-grams of words, their ends marked, and of the words themselves."""
    size = to - at + 2
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) - begin[word]
    inner = (place > 0) & (place < size[word] - 1)
    marked = np.where(place == 0, np.uint8(60), np.uint8(62))
    marked[inner] = lower(data[(at[word] + place - 1)[inner]])
    words, buckets = [np.arange(len(size))], [hashed(marked, begin, begin + size, 3)]
    for n in GRAMS:
        own = place + n <= size[word]
        words.append(word[own])
        where = np.flatnonzero(own)
        buckets.append(hashed(marked, where, where + n, 2))
    return np.concatenate(words), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)


def _word_scores(bucket_score: np.ndarray, bias: float, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    word, bucket = bags(data, at, to)
    return np.bincount(word, bucket_score[bucket], len(at)) / np.maximum(1, np.bincount(word, minlength=len(at))) + bias


def train(texts: list[bytes], labels: list[int], rounds: int = ROUNDS, seed: int = 5, damping: float = 1e-5, least_texts: int = 4) -> ToxicityModel:
    """Full-batch Adam on the embeddings and the softmax together; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum(size)
    owner, which, at, to = words_of(data, end - size, end)
    pair = np.unique(owner.astype(np.int64) * len(at) + which)  # a word counts once in a text
    owner, which = pair // len(at), pair % len(at)
    word, bucket = bags(data, at, to)
    grams = np.maximum(1, np.bincount(word, minlength=len(at)))
    y = np.asarray(labels, float)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    used = np.flatnonzero(np.diff(np.r_[-1, owner]))  # first pair of each text that has words
    texts_with = owner[used]
    span = np.diff(np.r_[used, len(owner)])
    # an n-gram of very few texts keeps a zero embedding, or single texts with a wrong label would be learnt by heart
    met = np.bincount(bucket, np.bincount(which, minlength=len(at))[word], BUCKETS)
    table = rng.normal(0, 0.02, (BUCKETS, WIDTH)).astype(np.float32)
    table[met < least_texts] = 0
    out, bias = rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)
    params = [table, out, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        heat = max(0.25, 2.0 * (1 - step / (0.6 * rounds)))
        slope, base = out[:, 1] - out[:, 0], bias[1] - bias[0]
        mean = np.bincount(word, (table @ slope)[bucket], len(at)) / grams
        score = mean[which] + base
        share = np.exp((score - np.repeat(np.maximum.reduceat(score, used), span)) / heat)
        share /= np.repeat(np.add.reduceat(share, used), span)
        logit = np.add.reduceat(share * score, used)
        g = (1 / (1 + np.exp(-logit)) - y[texts_with]) * weight[texts_with]
        by_word = np.bincount(which, share * np.repeat(g, span), len(at))
        by_bucket = np.where(met < least_texts, 0, np.bincount(bucket, (by_word / grams)[word], BUCKETS)).astype(np.float32)
        toward = table.T @ by_bucket
        grads = [by_bucket[:, None] * slope.astype(np.float32), np.stack([-toward, toward], axis=1), np.array([-g.sum(), g.sum()])]
        for p, d, m, v, rate in zip(params, grads, first, second, (0.05, 0.05, 0.05)):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + damping)).astype(p.dtype)
    bucket_score, base = (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])
    mean = np.bincount(word, bucket_score[bucket], len(at)) / grams
    top = np.maximum.reduceat(mean[which] + base, used)
    slope, shift = _calibrated(top, y[texts_with])
    return ToxicityModel(bucket_score, base, slope, shift)


def _calibrated(top: np.ndarray, y: np.ndarray, rounds: int = 400) -> tuple[float, float]:
    """Slope and shift of the logit of a text, fitted on its highest word score; targets drawn in a little."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    scale = max(1e-9, float(top.std()))
    x = (top - top.mean()) / scale
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g, h = p - target, np.maximum(1e-6, p * (1 - p))
        m = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(m, [(g * x).sum(), g.sum()])
        a, b = a - 0.5 * step[0], b - 0.5 * step[1]
    return a / scale, b - a * float(top.mean()) / scale


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_TEXTS) -> ToxicityModel | None:
    """Train on at most about ``sample`` texts of each class of ``labels`` (doc_id, toxic); None without both classes."""
    chosen = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("y")).where("__id is not null and y in (0, 1)").dropDuplicates(["__id"])
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("binary").alias("t")).where(F.octet_length("t").between(1, SAMPLE_BYTES))
    chosen = bounded_sample(rows.select("__id").join(chosen, "__id"), "y", sample, F.col("__id")).distinct()
    rows = rows.join(F.broadcast(chosen), "__id").select("y", "t")  # the sample is bounded
    got = sorted((r["y"], bytes(r["t"])) for r in rows.collect())
    if len({y for y, _ in got}) < 2:
        return None
    return train([t for _, t in got], [y for y, _ in got])


def score(docs: DataFrame, model: ToxicityModel | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic.

    Whole texts are scored, by their words alone; one without a word, empty or null has 0, as has every text if there is
    no model.  Other columns pass through; ``name`` must not be among them.
    """
    if name in docs.columns:
        raise ValueError(f"the table has a column {name}; choose another name")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at_column = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, start, end = flat_bytes(batch.column(at_column))
            found = np.zeros(batch.num_rows)
            for part in chunks(start, end, CHUNK_BYTES) if model else ():
                low, high = int(start[part][0]), int(end[part][-1])
                owner, which, at, to = words_of(data[low:high], start[part] - low, end[part] - low)
                if len(owner):
                    words = _word_scores(model.bucket_score, model.bias, data[low:high], at, to)
                    first = np.flatnonzero(np.diff(np.r_[-1, owner]))
                    top = np.maximum.reduceat(words[which], first)
                    found[part.start + owner[first]] = 1 / (1 + np.exp(-np.clip(model.slope * top + model.shift, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], schema.names)

    return docs.mapInArrow(run, schema)
