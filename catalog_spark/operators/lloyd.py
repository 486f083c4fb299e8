"""K-means for many runs at once: one Lloyd step of all restarts and all K is one pass over the rows.

The centres of the runs that still move are stacked into one table.  A task multiplies its rows with the whole table and
keeps counts and sums by centre; only these are combined and reach the driver, so a step costs the same few numbers
whatever the rows, and as many passes are made as the slowest run has steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from . import blocks

MAX_ITERATIONS = 300
TOLERANCE = 1e-4
POOL_ROUNDS = 3  # rounds of candidates for spread starts
POOL_SHARE = 2  # candidates a round, times the largest K
POOL_STEPS = 10  # Lloyd steps among the candidates
FEW_TASKS = 32  # sums of so many tasks are added up in one task, of more by a shuffle


@dataclass(frozen=True)
class Fit:
    """Centres, the sum of squared distances to them, and the steps made."""

    centers: np.ndarray
    cost: float
    steps: int


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Squared distances, both moved next to the origin first so that large offsets cost no digits."""
    middle = table.mean(axis=0)
    return blocks.squared_distances(x - middle, table - middle)


def _moments(runs: Sequence[np.ndarray]):
    """Arrow function over vectors: of each centre of each run, its rows, their squared distances and their sum."""
    table = np.vstack(runs)
    ends = np.cumsum([len(c) for c in runs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, sums = np.zeros(len(table), np.int64), np.zeros(len(table)), np.zeros(table.shape)
        for batch in batches:
            for low in range(0, batch.num_rows, blocks.BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(low, blocks.BLOCK_ROWS))
                d2, rows = _distances(x, table), np.arange(len(x))
                member = np.zeros((len(table), len(x)))
                for a, b in zip([0, *ends[:-1]], ends):
                    nearest = a + d2[:, a:b].argmin(axis=1)  # the first of equals
                    member[nearest, rows] = 1.0
                    np.add.at(cost, nearest, ((x - table[nearest]) ** 2).sum(axis=1))  # without the rounding of the product
                    np.add.at(n, nearest, 1)
                sums += member @ x
        yield from _written(n, cost, sums)

    return run


def _written(n: np.ndarray, cost: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = np.flatnonzero(n)
    if len(used):
        lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * sums.shape[1], sums[used].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(cost[used]), lists], ["slot", "n", "cost", "sums"])


def _added(slots: int, dims: int):
    """Arrow function over what the tasks found: the same, added up by centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, sums = np.zeros(slots, np.int64), np.zeros(slots), np.zeros((slots, dims))
        for batch in batches:
            slot = batch["slot"].to_numpy()
            for total, name in ((n, "n"), (cost, "cost")):
                np.add.at(total, slot, batch[name].to_numpy())
            np.add.at(sums, slot, _matrix(batch["sums"]))
        yield from _written(n, cost, sums)

    return run


def moments(rows: DataFrame, runs: Sequence[np.ndarray], vector: str = "vector", tasks: int | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, squared distances, sums) by centre, for every run, in one pass; what comes back is a row a centre.

    ``tasks`` is the number of partitions of ``rows``, if known.
    """
    few = (tasks or rows.rdd.getNumPartitions()) <= FEW_TASKS
    schema = "slot int, n long, cost double, sums array<double>"
    found, table = rows.select(vector).mapInArrow(_moments(runs), schema), np.vstack(runs)
    if few:  # in the order of the tasks, so that a fit can be repeated to the last digit
        found = found.withColumn("task", F.spark_partition_id()).repartition(1).sortWithinPartitions("task").drop("task").mapInArrow(_added(*table.shape), schema)
    else:
        total = Summarizer.metrics("sum").summary(array_to_vector("sums")).alias("s")
        found = found.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), total).select("slot", "n", "cost", vector_to_array("s.sum").alias("sums"))
    n, cost, sums = np.zeros(len(table)), np.zeros(len(table)), np.zeros(table.shape)
    for row in found.collect():
        n[row.slot] += row.n
        cost[row.slot] += row.cost
        sums[row.slot] += row.sums
    ends = np.cumsum([len(c) for c in runs])
    return [(n[a:b], cost[a:b], sums[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


def fit_many(rows: DataFrame, starts: Sequence[np.ndarray], vector: str = "vector", max_iterations: int = MAX_ITERATIONS, tolerance: float = TOLERANCE) -> list[Fit]:
    """A fit from each of ``starts``; a run stops when no centre moves by more than ``tolerance``.

    Rows without a vector take no part; a centre without rows stays where it is.  ``rows`` is read once a step, so the
    caller should have written or cached it.
    """
    rows = rows.where(F.col(vector).isNotNull())
    centers, steps = [np.asarray(c, dtype=float) for c in starts], [0] * len(starts)
    moving = [i for i, c in enumerate(centers) if len(c)]
    fitted, tasks = list(moving), rows.rdd.getNumPartitions()
    for _ in range(max_iterations):
        if not moving:
            break
        still = []
        for i, (n, _, sums) in zip(moving, moments(rows, [centers[i] for i in moving], vector, tasks)):
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers[i])
            far = ((new - centers[i]) ** 2).sum(axis=1).max()
            centers[i], steps[i] = new, steps[i] + 1
            if far > tolerance * tolerance:
                still.append(i)
        moving = still
    costs = dict(zip(fitted, (cost.sum() for _, cost, _ in moments(rows, [centers[i] for i in fitted], vector, tasks)))) if fitted else {}
    return [Fit(c, float(costs.get(i, 0.0)), s) for i, (c, s) in enumerate(zip(centers, steps))]


def row_starts(rows: DataFrame, ks: Sequence[int], restarts: int, row_id: str, vector: str = "vector") -> list[list[np.ndarray]]:
    """For each of ``ks``, ``restarts`` starts at rows of the table: the first k in the order of a digest of id and restart."""
    own = rows.where(F.col(vector).isNotNull()).select(F.col(row_id).alias("id"), F.col(vector).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("r"))
    order = Window.partitionBy("r").orderBy(F.md5(F.concat_ws(":", "id", "r")), "id")
    first = own.withColumn("j", F.row_number().over(order)).where(F.col("j") <= max(ks)).orderBy("r", "j").collect()  # max(ks) rows a restart
    by_restart = [[row.v for row in first if row.r == r] for r in range(restarts)]
    return [[np.array(found[:k], dtype=float) for found in by_restart] for k in ks]


def _uniform(h: np.ndarray, run: int, turn: int) -> np.ndarray:
    """A number in (0, 1) for each row hash, run and turn."""
    x = h.view(np.uint64) ^ np.uint64(((run + 1) * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD6E8FEB86659FD93) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def _candidates(pools: Sequence[np.ndarray], wanted: int, turn: int):
    """Arrow function (hash, vector): for each pool the rows that come first in a race at a speed of their squared distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros((0, 0)))] * len(pools)
        for batch in batches:
            h, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for i, pool in enumerate(pools):
                speed = _distances(x, pool).min(axis=1) if len(pool) else np.ones(len(x))
                key = np.full(len(x), np.inf)
                key[speed > 0] = -np.log(_uniform(h, i, turn)[speed > 0]) / speed[speed > 0]
                own = np.flatnonzero(np.isfinite(key))
                own = own[np.argsort(key[own])[:wanted]]
                keys, vectors = np.r_[best[i][0], key[own]], np.vstack([best[i][1].reshape(-1, x.shape[1]), x[own]])
                order = np.argsort(keys)[:wanted]
                best[i] = keys[order], vectors[order]
        for i, (keys, vectors) in enumerate(best):
            if len(keys):
                lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * vectors.shape[1], vectors.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), i, np.int32)), pa.array(keys), lists], ["pool", "key", "v"])

    return run


def _seeded(pool: np.ndarray, weight: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """``k`` spread points of a weighted pool, improved by a few Lloyd steps within it; fewer if there are no more."""
    picked = [int(random.choice(len(pool), p=weight / weight.sum()))]
    near = ((pool - pool[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < k and (weight * near).sum() > 0:
        share = weight * near
        picked.append(int(random.choice(len(pool), p=share / share.sum())))
        near = np.minimum(near, ((pool - pool[picked[-1]]) ** 2).sum(axis=1))
    centers = pool[picked].copy()
    for _ in range(POOL_STEPS):
        owner = ((pool[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        for j in range(len(centers)):
            own = owner == j
            if weight[own].sum() > 0:
                centers[j] = np.average(pool[own], axis=0, weights=weight[own])
    return centers


def spread_starts(rows: DataFrame, ks: Sequence[int], restarts: int, row_id: str, vector: str = "vector", seed: int = 42) -> list[list[np.ndarray]]:
    """For each of ``ks``, ``restarts`` spread starts (k-means|| seeding), all restarts in the same passes.

    A restart gathers a pool of candidates, far rows more likely, in rounds of one pass each; another pass counts the rows
    nearest to each, and every K draws its start from the weighted pool.  Pools have ``1 + POOL_ROUNDS * POOL_SHARE * max(ks)``
    points.  A table with fewer different rows than k gives as many centres as there are.
    """
    hashed = rows.where(F.col(vector).isNotNull()).select(F.xxhash64(F.col(row_id), F.lit(seed)).alias("h"), F.col(vector).alias("v"))
    pools: list[np.ndarray] = [np.zeros((0, 0))] * restarts
    for turn in range(POOL_ROUNDS + 1):
        wanted = POOL_SHARE * max(ks) if turn else 1
        order = Window.partitionBy("pool").orderBy("key")
        found = hashed.mapInArrow(_candidates(pools, wanted, turn), "pool int, key double, v array<double>")
        more: list[list] = [[] for _ in pools]
        for row in found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted).orderBy("pool", "rank").collect():
            more[row.pool].append(row.v)
        pools = [np.unique(np.vstack([p.reshape(-1, len(m[0])), m]), axis=0) if m else p for p, m in zip(pools, more)]
    if not len(pools[0]):
        return [[np.zeros((0, 0))] * restarts for _ in ks]
    weights = [n for n, _, _ in moments(hashed, pools, "v")]
    return [[_seeded(pool, n, k, np.random.default_rng([seed, r, k])) for r, (pool, n) in enumerate(zip(pools, weights))] for k in ks]


def best(fits: Sequence[Fit]) -> Fit:
    """The fit of least cost, the first of equals."""
    return min(fits, key=lambda f: f.cost)


def best_fits(rows: DataFrame, ks: Sequence[int], starts: list[list[np.ndarray]], vector: str = "vector", **limits) -> dict[int, Fit]:
    """The best fit of every K over its starts; all runs of all K go through the same passes."""
    if min(ks) < 2:
        raise ValueError("k must be at least 2")
    fits = fit_many(rows, [s for own in starts for s in own], vector, **limits)
    found, at = {}, 0
    for k, own in zip(ks, starts):
        found[k] = best(fits[at : at + len(own)])
        at += len(own)
    return found
