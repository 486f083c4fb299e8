"""Language of a text from a bidirectional gated recurrent network over its bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import bounded_sample, flat_bytes

HIDDEN = 8
SEGMENT = 256  # the recurrence starts anew after at most so many bytes, so a long text runs as many short lanes
LANES = 1024
PAD = 256
SAMPLE_TEXTS = 400  # training texts a language
WINDOWS, WINDOW = 4, 160  # training windows a text, characters a window
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Weights of both directions and of the output layer.

    The network is a gated recurrent unit whose bounded curve is x / (1 + |x|) in place of tanh, and half of that plus
    a half as the gate: one division where the usual curves need an exponential.
    """

    languages: list[str]
    table: list[np.ndarray]  # by direction: (3 H, 257), the input part of a byte; the last column is padding
    loop: list[np.ndarray]  # by direction: (3 H, H)
    out: np.ndarray  # (K, 2 H)
    bias: np.ndarray  # (K,)


def _padded(table: np.ndarray) -> np.ndarray:
    h = len(table) // 3
    table[:, PAD] = 0
    table[h : 2 * h, PAD] = 1e9  # the update gate is shut: a padded position leaves the state as it was
    return table


def _fresh(languages: list[str], hidden: int, rng: np.random.Generator) -> LanguageModel:
    k = len(languages)
    table = [_padded(rng.normal(0, 0.3, (3 * hidden, 257)).astype(np.float32)) for _ in range(2)]
    loop = [rng.normal(0, 0.3, (3 * hidden, hidden)).astype(np.float32) for _ in range(2)]
    return LanguageModel(languages, table, loop, rng.normal(0, 0.3, (k, 2 * hidden)).astype(np.float32), np.zeros(k, np.float32))


def _squash(x: np.ndarray) -> None:
    x /= np.abs(x) + 1


def _states(table: np.ndarray, loop: np.ndarray, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (T, H, N) after each step over the byte columns x (T, N); with ``keep``, what a backward pass needs."""
    h = loop.shape[1]
    steps, n = x.shape
    states, past = np.empty((steps, h, n), np.float32), []
    state = np.zeros((h, n), np.float32)
    for t in range(steps):
        given, own = np.take(table, x[t], axis=1, mode="clip"), loop @ state
        gates = given[: 2 * h]
        gates += own[: 2 * h]
        _squash(gates)
        gates += 1
        gates *= 0.5  # r, z
        fresh = gates[:h] * own[2 * h :]
        fresh += given[2 * h :]
        _squash(fresh)
        old = state
        state = states[t]
        np.subtract(old, fresh, out=state)
        state *= gates[h:]
        state += fresh
        if keep:
            past.append((old, gates, fresh, own[2 * h :]))
    return states, past


def _position_probabilities(model: LanguageModel, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    """(T, K, N) from the states of both directions at each position."""
    h = ahead.shape[1]
    logits = np.matmul(model.out[:, :h], ahead)
    logits += np.matmul(model.out[:, h:], back)
    logits += model.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _gradients(model: LanguageModel, x: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of the windows x (T, N) and its gradients, by backpropagation through time."""
    h, (steps, n) = model.loop[0].shape[1], x.shape
    runs = [_states(model.table[0], model.loop[0], x, True), _states(model.table[1], model.loop[1], x[::-1], True)]
    p = _position_probabilities(model, runs[0][0], runs[1][0][::-1])
    real = (x != PAD).astype(np.float32)
    weight = real / real.sum()
    loss = -float((np.log(np.maximum(p[:, labels, np.arange(n)], 1e-9)) * weight).sum())
    p[:, labels, np.arange(n)] -= 1
    p *= weight[:, None, :]
    both = [runs[0][0], runs[1][0][::-1]]
    out = np.concatenate([np.einsum("tkn,thn->kh", p, s, optimize=True) for s in both], axis=1)
    grads = [out, p.sum(axis=(0, 2))]
    for d in range(2):
        into = np.matmul(model.out[:, d * h : (d + 1) * h].T, p)
        order = x if d == 0 else x[::-1]
        into = into if d == 0 else into[::-1]
        loop, table = np.zeros_like(model.loop[d]), np.zeros((257, 3 * h), np.float32)
        carried = np.zeros((h, n), np.float32)
        deltas = np.empty((steps, n, 3 * h), np.float32)
        for t in range(steps - 1, -1, -1):
            old, gates, fresh, own = runs[d][1][t]
            r, z = gates[:h], gates[h:]
            g = into[t] + carried
            gn = g * (1 - z) * (1 - np.abs(fresh)) ** 2
            gz = g * (old - fresh) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            gr = gn * own * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            by_loop = np.concatenate([gr, gz, gn * r])
            loop += by_loop @ old.T
            carried = g * z + model.loop[d].T @ by_loop
            deltas[t] = np.concatenate([gr, gz, gn]).T
        np.add.at(table, order.ravel(), deltas.reshape(-1, 3 * h))
        table[PAD] = 0
        grads += [table.T, loop]
    return loss, grads


def train(texts: list[bytes], languages: list[str], hidden: int = HIDDEN, rounds: int = 450, lanes: int = 192, width: int = 48, seed: int = 7) -> LanguageModel:
    """Fit on short texts with their languages, by Adam on random windows; every language is drawn equally often."""
    rng = np.random.default_rng(seed)
    known = sorted(set(languages))
    model = _fresh(known, hidden, rng)
    by = [[np.frombuffer(t, np.uint8) for t, l in zip(texts, languages) if l == k and t] for k in known]
    weights = [model.out, model.bias, model.table[0], model.loop[0], model.table[1], model.loop[1]]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        x, labels = np.full((width, lanes), PAD, np.int64), np.arange(lanes) % len(known)
        for i, k in enumerate(labels):
            text = by[k][rng.integers(len(by[k]))]
            at = rng.integers(max(1, len(text) - width + 1))
            piece = text[at : at + width]
            x[: len(piece), i] = piece
        _, grads = _gradients(model, x, labels)
        scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
        rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / rounds))
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g * scale - m)
            v += 0.01 * ((g * scale) ** 2 - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        for table in model.table:
            _padded(table)
    return model


def _pooled(model: LanguageModel, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mean over all positions of each text of the probabilities there; (texts, K)."""
    size = end - start
    pieces = -(-size // SEGMENT)
    doc = np.repeat(np.arange(len(size)), pieces)
    place = np.arange(len(doc)) - np.repeat(np.r_[0, np.cumsum(pieces)[:-1]], pieces)
    a, b = (start[doc] + (place + i) * size[doc] // pieces[doc] for i in (0, 1))
    sums = np.zeros((len(size), len(model.languages)))
    order = np.argsort(b - a, kind="stable")
    for at in range(0, len(order), LANES):
        own = order[at : at + LANES]
        width = int((b[own] - a[own]).max())
        where = a[own] + np.arange(width)[:, None]
        inside = where < b[own]
        x = np.where(inside, data[np.minimum(where, len(data) - 1)].astype(np.intp), PAD)
        ahead, _ = _states(model.table[0], model.loop[0], x, False)
        back, _ = _states(model.table[1], model.loop[1], x[::-1], False)
        p = _position_probabilities(model, ahead, back[::-1])
        if not inside.all():
            p *= inside[:, None, :]
        np.add.at(sums, doc[own], p.sum(axis=0).T)
    return sums / np.maximum(1, size)[:, None]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE_TEXTS) -> LanguageModel | None:
    """Train on windows of at most about ``sample`` texts a language; None if no row has a letter and a language.

    Copies of a text count once, however many of them there are.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null").where(F.col("text").rlike("\\p{L}"))
    rows = bounded_sample(rows, "lang", sample, F.col("text")).dropDuplicates(["lang", "text"])
    spots = [F.substring("text", (F.pmod(F.xxhash64("text", F.lit(i)), F.greatest(F.lit(1), F.char_length("text") - WINDOW)) + 1).cast("int"), F.lit(WINDOW)) for i in range(WINDOWS)]
    got = rows.select("lang", F.explode(F.array(*spots)).alias("t")).orderBy("lang", "t").collect()
    return train([r["t"].encode() for r in got], [r["lang"] for r in got]) if got else None


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its pooled probability.

    Every byte of a text is labelled; a text that is null, empty or without a letter gets ``und`` and score 0, as does
    every text if there is no model.  Only the text is looked at; other columns pass through, and ``names`` must not be
    among them.
    """
    pred, score = names
    if set(names) & set(docs.columns):
        raise ValueError(f"the table has a column named like {names}; choose other names")
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    letter = "__letter"
    while letter in docs.columns:
        letter += "_"
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            data, start, end = flat_bytes(batch.column(at))
            end = np.where(has, end, start)
            best, top = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None and (end > start).any():
                p = _pooled(model, data, start, end)
                which, top = p.argmax(axis=1), np.where(end > start, np.clip(p.max(axis=1), 0, 1), 0.0)
                best = [model.languages[k] if e > s else UNKNOWN for k, s, e in zip(which, start, end)]
            columns = [*batch.columns[:-1], pa.array(best, pa.string()), pa.array(top, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.withColumn(letter, F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))).mapInArrow(run, schema)
