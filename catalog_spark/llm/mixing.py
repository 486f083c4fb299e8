"""Mixing documents to target weights of domains, with soft membership.

A classifier learnt from a labelled table gives every document posteriors over domains.  Nonnegative rates of the documents
are then fitted by projected gradient steps, with momentum, on the squared distance between the expected tokens of each
domain and its target.  A step needs the domain totals only: K sums that combine map-side.  A task works out the rates of
its documents from the latest steps; after every ``REPLAY`` steps the rates are written beside the posteriors.

The fit ends when the targets are met, or when the dual of the problem proves that no nonnegative rates come closer.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .text import bounded_sample, chunks, flat_bytes, hashed, spans

FEATURES = 1 << 17
SAMPLE_TEXTS = 2500  # labelled texts a domain
CHUNK_BYTES = 1 << 20
TOLERANCE = 1e-4  # of the total, by which a domain may miss its target
PROOF = 1e-3  # of the total, within which the totals are proved to be of the closest ones if targets cannot be met
PROVE = 24  # steps after which the proof is tried
REPLAY = 960  # steps after which the rates are written down; up to there, going through the steps costs less than a table

log = logging.getLogger(__name__)


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # (features, K), scaled to integers / scale, so that they travel small
    bias: np.ndarray


def _features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, of texts in order, and the number of words of each text."""
    owner, at, to = spans(data, start, end, symbols=False)
    words = np.bincount(owner, minlength=len(start))
    owner, at, to = spans(data, start, end, symbols=True)
    whole = hashed(data, at, to, fold=True) % np.uint64(FEATURES // 2)
    head = hashed(data, at, np.minimum(to, at + 5)) % np.uint64(FEATURES // 2) + np.uint64(FEATURES // 2)
    both = (np.r_[owner, owner].astype(np.uint64) << np.uint64(32)) | np.r_[whole, head]
    both.sort()  # np.unique goes through a hash table, which takes far longer
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    both = both[fresh]
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), words


def _scores(model_weights: np.ndarray, bias: np.ndarray, owner: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
    """Softmax over domains of the features' weights, summed and divided by the root of their number."""
    k = len(bias)
    sums = np.zeros((n, k))
    for j in range(k):
        sums[:, j] = np.bincount(owner, model_weights[feature, j], n)
    sums /= np.sqrt(np.maximum(1, np.bincount(owner, minlength=n)))[:, None]
    sums += bias
    sums = np.exp(sums - sums.max(axis=1, keepdims=True))
    return sums / sums.sum(axis=1, keepdims=True)


def train(texts: list[list[int]], labels: list[str], rounds: int = 12, batch: int = 128, seed: int = 1) -> DomainModel:
    """Softmax regression on feature sets, by AdaGrad."""
    domains = sorted(set(labels))
    rng = np.random.default_rng(seed)
    k = len(domains)
    weights, seen, bias = np.zeros((FEATURES, k), np.float32), np.full((FEATURES, k), 1e-3, np.float32), np.zeros(k)
    y = np.array([domains.index(l) for l in labels])
    sets = [np.asarray(t, np.int64) for t in texts]
    for _ in range(rounds):
        order = rng.permutation(len(sets))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            owner = np.repeat(np.arange(len(own)), [len(sets[j]) for j in own])
            feature = np.concatenate([sets[j] for j in own])
            g = _scores(weights, bias, owner, feature, len(own))
            g[np.arange(len(own)), y[own]] -= 1
            scale = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(own))))
            bias -= 0.2 * g.mean(axis=0)
            used, where = np.unique(feature, return_inverse=True)
            for j in range(k):
                step = np.bincount(where, (g[:, j] * scale)[owner], len(used)).astype(np.float32)
                seen[used, j] += step * step
                weights[used, j] -= 0.3 * step / np.sqrt(seen[used, j])
    return DomainModel(domains, weights.astype(np.float16), bias)


def fit_domains(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_TEXTS) -> DomainModel | None:
    """Learn from the rows of ``labelled`` (doc_id, domain), at most about ``sample`` a domain; None if there are none."""
    chosen = labelled.select(F.col("doc_id").alias("__id"), "domain").where("__id is not null and domain is not null").dropDuplicates(["__id"])
    chosen = bounded_sample(chosen, "domain", sample, F.col("__id"))
    # the sample is bounded, so the texts need not move to meet it; of rows with one id, the first text counts
    texts = docs.select(F.col(doc_id).alias("__doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    rows = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).groupBy("__id", "domain").agg(F.min("__text").alias("t")).select("domain", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, start, end = flat_bytes(batch.column(1))
            for part in chunks(start, end, CHUNK_BYTES):
                owner, feature, _ = _features(data, start[part], end[part])
                offsets = np.searchsorted(owner, np.arange(part.stop - part.start + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))], ["domain", "features"])

    got = rows.mapInArrow(run, "domain string, features array<int>").collect()
    got.sort(key=lambda r: (r["domain"], len(r["features"]), r["features"][:8]))
    return train([r["features"] for r in got], [r["domain"] for r in got]) if got else None


def posteriors(docs: DataFrame, model: DomainModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, check, tokens, p) for every row: its words, and its probability of each domain; without a model, one domain.

    ``row`` and ``check`` are two hashes of id and text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weights = model.weights.astype(np.float32) if model else None
        for batch in batches:
            data, start, end = flat_bytes(batch.column(3))
            for part in chunks(start, end, CHUNK_BYTES):
                n = part.stop - part.start
                owner, feature, words = _features(data, start[part], end[part])
                p = _scores(weights, model.bias, owner, feature, n) if model else np.ones((n, 1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(part.start, n) for i in range(3)), pa.array(words.astype(np.int64)), lists], ["doc_id", "row", "check", "tokens", "p"])

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *_hashes(doc_id, text), body.alias("t"))
    return rows.mapInArrow(run, "doc_id long, row long, check long, tokens long, p array<double>")


def _hashes(doc_id: str, text: str) -> list:
    """128 bits that tell a row from all others, as two columns."""
    key, body = F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(key, body).alias("row"), F.xxhash64(F.lit("check"), body, key).alias("check")]


@dataclass(frozen=True)
class Fit:
    """``members`` (with the rates ``now`` and ``last`` of the steps written down), the later steps, and what was reached.

    ``gap`` bounds how much closer, in tokens of any domain, other rates could come to the targets' best.
    """

    members: DataFrame
    steps: np.ndarray  # a row a step: momentum, then the move along each domain
    reached: np.ndarray
    wanted: np.ndarray
    taken: int
    met: bool
    gap: float


def _rates(p: np.ndarray, steps: np.ndarray, now: np.ndarray | None = None, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rates after all steps and before the last one: each goes on a little, moves along the posteriors and stops at zero."""
    now = np.ones(len(p)) if now is None else now
    last = now if last is None else last
    for step in steps:
        now, last = np.maximum(0.0, now + step[0] * (now - last) + p @ step[1:]), now
    return now, last


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _rated(batch: pa.RecordBatch, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(posteriors, tokens, rates now, rates before) of a batch of members."""
    column = {n: batch.column(n) for n in ("p", "tokens", "now", "last")}
    p = _matrix(column["p"])
    return p, column["tokens"].to_numpy(), *_rates(p, steps, column["now"].to_numpy(), column["last"].to_numpy())


def _totals(members: DataFrame, steps: np.ndarray, k: int) -> np.ndarray:
    """Expected tokens of each domain at the rates that ``steps`` lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                p, tokens, now, _ = _rated(batch, steps)
                sums += (tokens * now) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(sums)], ["k", "s"])

    rows = members.select("tokens", "p", "now", "last").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    found = np.zeros(k)
    for r in rows:
        found[r["k"]] = r["s"]
    return found


def _written(members: DataFrame, steps: np.ndarray) -> DataFrame:
    """The members with the rates that ``steps`` lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, _, now, last = _rated(batch, steps)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(now), pa.array(last)], batch.schema.names)

    return materialize(members.mapInArrow(run, members.schema), "members")


def _bound(members: DataFrame, miss: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> float:
    """A proved lower bound of the objective: a multiplier made feasible by the least product with any document's posteriors."""
    slope = weight * miss
    dot = sum((F.element_at("p", i + 1) * F.lit(float(v)) for i, v in enumerate(slope)), F.lit(0.0))
    least = members.where("tokens > 0").agg(F.min(dot).alias("least")).first()["least"]
    slope = np.where(weight > 0, slope + max(0.0, -(least or 0.0)), 0.0)
    gain, size = -float(slope @ wanted), float(np.divide(slope * slope, weight, out=np.zeros_like(slope), where=weight > 0).sum())
    return gain * gain / (2 * size) if gain > 0 and size > 0 else 0.0


def fit_steps(members: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None, most: int | None = None) -> Fit:
    """Rates by projected gradient, with momentum, on the weighted squared distance to the targets.

    ``targets`` are weights of the domains, a domain without one gets nothing; ``total`` is the number of tokens wanted,
    as many as there are by default.  The rates start at one and are measured by tokens, so the fit changes them no more
    than the targets ask for.  A domain that no document can belong to is left out of the fit.

    Steps go on until each domain is within ``TOLERANCE`` of its target or, where the targets are out of reach of any
    rates, until the totals are proved to lie within ``PROOF`` of the closest ones; ``most`` stops the fit before that.
    """
    k = len(domains)
    products = [F.sum(F.col("tokens") * F.element_at("p", i + 1) * F.element_at("p", j + 1)).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]
    first = members.agg(F.sum("tokens").alias("n"), *products).first()
    gram = np.array([[first[f"g{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    wanted = share / max(share.sum(), 1e-300) * (total if total is not None else float(first["n"] or 0))
    weight = np.where(np.diag(gram) > 0, 1 / np.maximum(np.diag(gram), 1e-300), 0.0)
    root = np.sqrt(weight)
    top = float(np.linalg.eigvalsh(root[:, None] * gram * root[None, :]).max()) if k else 0.0
    size = max(1.0, wanted.sum())
    members = members.withColumns({"now": F.lit(1.0), "last": F.lit(1.0)})
    steps, taken, pace, gap = np.zeros((0, 1 + k)), 0, 1.0, 0.0
    reached = before = _totals(members, steps, k)
    missed = lambda: float((np.abs(reached - wanted) * (weight > 0)).max(initial=0.0))
    cost = lambda at: float((weight * (at - wanted) ** 2).sum()) / 2
    met = top <= 0 or missed() <= TOLERANCE * size
    while not met and (most is None or taken < most):
        if taken and cost(reached) > cost(before):
            pace = 1.0  # the momentum led away
        ahead = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        push, pace = (pace - 1) / ahead, ahead
        # the totals are linear in the rates, so those of the pushed rates need no pass of their own
        move = -(weight / top) * (reached + push * (reached - before) - wanted)
        steps, taken = np.vstack([steps, np.r_[push, move]]), taken + 1
        before, reached = reached, _totals(members, steps, k)
        met = missed() <= TOLERANCE * size
        if not met and len(steps) == REPLAY:
            members, steps = _written(members, steps), steps[:0]
        if not met and taken % PROVE == 0:
            excess = max(0.0, cost(reached) - _bound(members, reached - wanted, wanted, weight))
            gap = float(np.sqrt(2 * excess / weight[weight > 0].min()))
            if gap <= PROOF * size or abs(cost(reached) - cost(before)) <= 1e-15 * cost(reached):  # or nothing moves any more
                break
    if not met:
        log.warning("targets not met after %d steps: %s", taken, {d: (round(float(r)), round(float(w))) for d, r, w in zip(domains, reached, wanted)})
    return Fit(members, steps, reached, wanted, taken, met, gap)


def mix(
    docs: DataFrame, model: DomainModel | None, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text", total: float | None = None, seed: int = 11, strict: bool = False
) -> DataFrame:
    """(doc_id, row, check, tokens, domain, p, rate, copies, wanted, reached) for every row of ``docs``.

    ``rate`` is how often the document is wanted on average, ``copies`` that number rounded up or down by a hash of the
    row, so the expected tokens of the domains match the targets.  ``domain`` is the likeliest one, the first of equals;
    ``wanted`` and ``reached`` are the tokens that this domain should have and has at the rates: they differ where no
    nonnegative rates meet the targets, which is an error if ``strict``.  A null text counts as empty, with no tokens; its
    rate is fitted like any other.  Equal rows get equal numbers, rows with a null doc_id included.  An empty table
    gives an empty result; other columns are not looked at, whatever their names.
    """
    domains = model.domains if model else ["all"]
    fit = fit_steps(materialize(posteriors(docs, model, doc_id, text), "members"), domains, targets if model else {"all": 1.0}, total)
    if strict and not fit.met:
        raise ValueError(f"no rates meet the targets: {dict(zip(domains, fit.reached))} instead of {dict(zip(domains, fit.wanted))}")
    steps, reached, wanted = fit.steps, fit.reached, fit.wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p, _, now, _ = _rated(batch, steps)
                best = p.argmax(axis=1)
                found = [pa.array([domains[i] for i in best], pa.string()), *(pa.array(v) for v in (now, wanted[best], reached[best]))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *found], [*batch.schema.names[:-2], "domain", "rate", "wanted", "reached"])

    added = [T.StructField("domain", T.StringType()), *(T.StructField(n, T.DoubleType()) for n in ("rate", "wanted", "reached"))]
    schema = T.StructType([*fit.members.schema.fields[:-2], *added])
    draw = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = fit.members.mapInArrow(run, schema)
    return rated.select("doc_id", "row", "check", "tokens", "domain", "p", "rate", F.floor(F.col("rate") + draw).alias("copies"), "wanted", "reached")


def mixed(docs: DataFrame, model: DomainModel | None, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text", total: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` says; columns of any name pass by."""
    found = mix(docs, model, targets, doc_id, text, total).where("copies > 0").groupBy("row", "check").agg(F.max("copies").alias("copies"))
    packed = docs.select(F.struct("*").alias("kept"), *_hashes(doc_id, text))
    chosen = packed.join(found, ["row", "check"])
    return chosen.select("kept", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("kept.*")
