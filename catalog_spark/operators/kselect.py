"""Metrics over the number of clusters and the choice of K."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialize
from . import blocks, lloyd
from .cluster import SWEEP_RESTARTS, cluster_moments, fit_minibatch
from .summary import min_max_scale

# Score weights and the slack that favours the elbow.
SILHOUETTE_WEIGHT, CH_WEIGHT = 0.55, 0.45
ELBOW_GAP, ELBOW_SLACK = 2, 0.98
EPS = 1e-9
GROUP_VALUES = 1 << 24  # numbers of the rows that a task compares with all others: 128 MB


def partition_metrics(df: DataFrame, labels: dict[int, str], vector: str = "vector") -> DataFrame:
    """(k, inertia, calinski_harabasz) for each label column, all in one pass over the vectors.

    ``labels`` maps k to the column with the cluster ids of that partition.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("int").alias("cluster_id")) for k, c in labels.items()])
    long = df.select(F.col(vector).alias("__x"), F.inline(pairs))
    return metrics_from_moments(cluster_moments(long, ["k", "cluster_id"], "__x"))


def metrics_from_moments(moments: DataFrame) -> DataFrame:
    """Inertia and Calinski-Harabasz per k from (k, cluster_id, n, center, within): tables of k rows each."""
    cells = moments.select("k", "cluster_id", "n", F.posexplode("center").alias("p", "x"))
    mean = cells.groupBy("k", "p").agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("m"))
    between = (
        cells.join(mean, ["k", "p"])
        .groupBy("k")
        .agg(F.sum(F.col("n") * (F.col("x") - F.col("m")) * (F.col("x") - F.col("m"))).alias("between"))
    )
    totals = moments.groupBy("k").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.sum("within").alias("inertia"))
    ratio = (F.col("between") / (F.col("c") - 1)) / (F.col("inertia") / (F.col("n") - F.col("c")))
    defined = (F.col("c") > 1) & (F.col("n") > F.col("c"))
    # Without any spread inside the clusters the index is 1 by convention.
    ch = F.when(defined & (F.col("inertia") > 0), ratio).when(defined, F.lit(1.0))
    return totals.join(between, "k").select("k", "inertia", ch.alias("calinski_harabasz"))


def silhouette_squared(df: DataFrame, vector: str, labels: dict[int, str]) -> DataFrame:
    """(k, silhouette): mean silhouette of each partition by squared Euclidean distance, over all rows.

    The mean squared distance of a row to a cluster follows from the cluster's centre and spread, so two passes serve all
    partitions and nothing grows with the square of the rows.  What reaches the driver is k rows a partition.
    """
    ks = list(labels)
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("int").alias("cluster_id")) for k, c in labels.items()])
    moments: dict[int, list] = {k: [] for k in ks}
    for r in cluster_moments(df.select(F.col(vector).alias("__x"), F.inline(pairs)), ["k", "cluster_id"], "__x").collect():
        moments[r.k].append((r.cluster_id, r.n, r.center, r.within))
    tables = []
    for k in ks:
        own = sorted(moments[k])
        tables.append(tuple(np.array([m[i] for m in own], dtype=float) for i in range(4)))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scores(vectors: pd.Series, clusters: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=object)
        x, own = np.stack(vectors.to_numpy()), np.stack(clusters.to_numpy())
        out = np.full((len(x), len(tables)), np.nan)
        for j, (names, n, centers, within) in enumerate(tables):
            if len(names) < 2:
                continue
            mean = blocks.squared_distances(x, centers) + within / n
            at, rows = np.searchsorted(names, own[:, j]), np.arange(len(x))
            a = mean[rows, at] * n[at] / np.maximum(1, n[at] - 1)
            mean[rows, at] = np.inf
            b = mean.min(axis=1)
            widest = np.maximum(a, b)
            out[:, j] = np.where((n[at] > 1) & (widest > 0), (b - a) / np.where(widest > 0, widest, 1), 0.0)
        return pd.Series(list(out))

    scored = df.select(scores(F.col(vector), F.array(*[F.col(c).cast("int") for c in labels.values()])).alias("s"))
    sums = scored.agg(*[F.avg(F.nanvl(F.col("s")[j], F.lit(None))).alias(f"s{j}") for j in range(len(ks))])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"s{j}").alias("silhouette")) for j, k in enumerate(ks)])))


def silhouette(df: DataFrame, row_id: str, vector: str, labels: dict[int, str]) -> DataFrame:
    """(k, silhouette): mean Euclidean silhouette of each partition, over all rows.

    The rows are dealt into groups, and a task holds one group while all rows pass by in small matrix products that serve
    all partitions at once; sums per row and cluster stay with the task, so what is shuffled is the table once a group.
    The work grows with the square of the rows, which this distance asks for; ``silhouette_squared`` is the measure for
    large tables.  Groups are ``GROUP_VALUES`` numbers at most, and as few as give every core work.
    """
    ks, columns = list(labels), list(labels.values())
    own = F.array(*[F.col(c).cast("int") for c in columns])
    chosen = materialize(df.select(F.col(row_id).alias("__id"), F.col(vector).alias("x"), own.alias("l")), "silhouette")
    seen = chosen.select(F.posexplode("l").alias("j", "c")).groupBy("j", "c").agg(F.count("*").alias("n")).collect()  # a row a cluster
    names = [np.array(sorted(r.c for r in seen if r.j == j)) for j in range(len(ks))]
    counts = [np.array([n for _, n in sorted((r.c, r.n) for r in seen if r.j == j)], dtype=float) for j in range(len(ks))]
    n, cells = chosen.count(), sum(len(own) for own in names)
    width = cells + (chosen.select(F.max(F.size("x"))).first()[0] or 1)
    groups = max(min(2 * df.sparkSession.sparkContext.defaultParallelism, -(-n // blocks.BLOCK_ROWS)), -(-n * width // GROUP_VALUES), 1)
    home = F.pmod(F.xxhash64("__id"), F.lit(groups)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(groups - 1))
    dealt = chosen.select("x", "l", home.alias("home"), F.explode(everywhere).alias("at"))
    dealt = dealt.select("x", "l", (F.col("home") == F.col("at")).alias("own"), "at").repartitionById(groups, "at").sortWithinPartitions(F.desc("own"))
    found = dealt.select("x", "l", "own").mapInArrow(_silhouettes(names, counts), "j int, total double, n long")
    sums = found.groupBy("j").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("silhouette"))
    named = F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("j") + 1)
    return sums.select(named.alias("k"), "silhouette")


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _silhouettes(names: list[np.ndarray], counts: list[np.ndarray]):
    """Arrow function over rows (x, l, own), the own ones first: for each partition the sum of their silhouettes by all rows."""
    starts = np.cumsum([0, *[len(c) for c in names]])

    def run(batches):
        mine: list[tuple[np.ndarray, np.ndarray]] = []
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            there, theirs, ours = _flat(batch, "x"), _flat(batch, "l"), batch["own"].to_numpy(zero_copy_only=False)
            if held is None:
                mine.append((there[ours], theirs[ours]))
                if ours.all():
                    continue
                held = among(mine)
            add(held[2], held[0], there[~ours], theirs[~ours])
        if held is None and mine:
            held = among(mine)
        if held is None or not len(held[0]):
            return
        _, own, sums = held
        out = [_mean_silhouette(sums[:, a:b], counts[j], np.searchsorted(names[j], own[:, j])) for j, (a, b) in enumerate(zip(starts, starts[1:]))]
        found = [(j, total or 0.0, 0 if total is None else len(own)) for j, total in enumerate(out)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate((pa.int32(), pa.float64(), pa.int64()))], ["j", "total", "n"])

    def among(mine):
        """The rows of the group, their clusters, and the distances among themselves, added up by cluster."""
        x, own = (np.concatenate(z) for z in zip(*mine))
        sums = np.zeros((len(x), starts[-1]))
        for low in range(0, len(x), blocks.BLOCK_ROWS):
            add(sums, x, x[low : low + blocks.BLOCK_ROWS], own[low : low + blocks.BLOCK_ROWS], low)
        return x, own, sums

    def add(sums, x, others, theirs, at=None):
        """Add the distances of the rows to ``others`` by cluster; those are the rows from ``at`` on, if given."""
        alike, index = np.unique(theirs, axis=0, return_inverse=True)
        member = np.zeros((len(others), len(alike)))
        member[np.arange(len(others)), index.ravel()] = 1.0
        columns = [starts[j] + np.searchsorted(names[j], alike[:, j]) for j in range(len(names))]
        for low in range(0, len(x), blocks.BLOCK_ROWS):
            d = blocks.squared_distances(x[low : low + blocks.BLOCK_ROWS], others)
            np.sqrt(d, out=d)
            if at == low:
                np.fill_diagonal(d, 0.0)
            total = d @ member
            for at_column in columns:
                for i, c in enumerate(at_column):
                    sums[low : low + blocks.BLOCK_ROWS, c] += total[:, i]

    return run


def _mean_silhouette(sums: np.ndarray, counts: np.ndarray, own: np.ndarray) -> float | None:
    """Sum of the silhouettes of rows by their distance sums to each cluster; None if there is but one cluster."""
    if len(counts) < 2:
        return None
    rows, size = np.arange(len(sums)), counts[own]
    a = sums[rows, own] / np.maximum(1, size - 1)
    mean = sums / counts
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    widest = np.maximum(a, b)
    return float(np.where((size > 1) & (widest > 0), (b - a) / np.where(widest > 0, widest, 1), 0.0).sum())


def elbow_k(metrics: DataFrame, k: str = "k", inertia: str = "inertia") -> DataFrame:
    """One row with ``inertia_elbow_k``: the K farthest from the chord of the normalised curve.

    With fewer than three points it is the K of the largest inertia.  ``metrics``
    has one row per K.
    """
    everything = Window.partitionBy(F.lit(1))
    lo, hi = F.min(k).over(everything), F.max(k).over(everything)
    bottom, top = F.min(inertia).over(everything), F.max(inertia).over(everything)
    points = metrics.select(
        F.col(k).alias("k"),
        F.col(inertia).alias("inertia"),
        F.count("*").over(everything).alias("points"),
        ((F.col(k) - lo) / (hi - lo + EPS)).alias("x"),
        ((F.col(inertia) - bottom) / (top - bottom + EPS)).alias("y"),
    )
    along = everything.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x1, y1 = F.first("x").over(along), F.first("y").over(along)
    x2, y2 = F.last("x").over(along), F.last("y").over(along)
    dx, dy = x2 - x1, y2 - y1
    # The cross product with the chord is the distance from it times its length, which is the same for all points.
    scored = points.withColumn("off", F.abs((F.col("x") - x1) * dy - (F.col("y") - y1) * dx))
    by = F.when(F.col("points") < 3, F.col("inertia")).otherwise(F.col("off"))
    return scored.withColumn("by", by).agg(F.min_by("k", F.struct(-F.col("by"), F.col("k"))).alias("inertia_elbow_k"))


def score_table(metrics: DataFrame) -> DataFrame:
    """Add elbow, normalised metrics and score to (k, inertia, silhouette, calinski_harabasz)."""
    elbow = elbow_k(metrics).scalar()
    scored = min_max_scale(metrics, "silhouette", "sil_norm")
    scored = min_max_scale(scored, "calinski_harabasz", "ch_norm")
    return scored.select(
        "k",
        "inertia",
        "silhouette",
        "calinski_harabasz",
        elbow.alias("inertia_elbow_k"),
        "sil_norm",
        "ch_norm",
        (F.lit(SILHOUETTE_WEIGHT) * F.col("sil_norm") + F.lit(CH_WEIGHT) * F.col("ch_norm")).alias("score"),
    )


def choose_k(scores: DataFrame) -> DataFrame:
    """One row: the best-scoring K, or the elbow if it is two or more away and nearly as good."""
    picked = scores.agg(
        F.min_by(F.struct("k", "score"), F.struct(F.col("score").isNull(), -F.col("score"), F.col("k"))).alias("best"),
        F.max(F.struct(F.when(F.col("k") == F.col("inertia_elbow_k"), F.col("score")).alias("s"))).alias("elbow"),
        F.max("inertia_elbow_k").alias("elbow_k"),
    )
    best, elbow_score = F.col("best.score"), F.coalesce(F.col("elbow.s"), F.lit(-1.0))
    far = F.abs(F.col("best.k") - F.col("elbow_k")) >= ELBOW_GAP
    prefer = far & (elbow_score > 0) & (elbow_score >= best * ELBOW_SLACK)
    return picked.select(
        F.col("best.k").alias("best_k"),
        F.col("elbow_k").alias("inertia_elbow_k"),
        F.when(prefer, F.col("elbow_k")).otherwise(F.col("best.k")).alias("chosen_k"),
    )


def assign_all(models: dict[int, np.ndarray]):
    """Arrow function: cluster id under every model, in the order of the models."""
    tables = list(models.values())

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def assign(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=object)
        x = np.stack(vectors.to_numpy())
        columns = [blocks.squared_distances(x - t.mean(axis=0), t - t.mean(axis=0)).argmin(axis=1) for t in tables]
        return pd.Series(list(np.stack(columns, axis=1).astype("int32")))

    return assign


def sweep(
    df: DataFrame,
    k_min: int,
    k_max: int,
    row_id: str,
    features: str = "features",
    restarts: int = SWEEP_RESTARTS,
    seed: int = 42,
    minibatch: bool = False,
) -> DataFrame:
    """Metric table over K.  ``df`` holds a vector column; cache it before the call.

    All restarts of all K go through the same passes, one a Lloyd step; then one pass
    gives inertia and Calinski-Harabasz of all K, and two the silhouettes of all K, by
    squared distance and over every row.
    """
    if k_min < 2 or k_max < k_min:
        raise ValueError("need 2 <= k_min <= k_max")
    rows = df.select(row_id, vector_to_array(features).alias("__x")).persist()
    try:
        if minibatch:
            models = {k: fit_minibatch(rows, k, row_id, "__x", seed=seed, restarts=restarts) for k in range(k_min, k_max + 1)}
        else:
            ks = list(range(k_min, k_max + 1))
            models = {k: fit.centers for k, fit in lloyd.best_fits(rows, ks, lloyd.spread_starts(rows, ks, restarts, row_id, "__x", seed), "__x").items()}
        return metrics_of(rows, models, row_id, "__x")
    finally:
        rows.unpersist()


def metrics_of(rows: DataFrame, models: dict[int, np.ndarray], row_id: str, vector: str) -> DataFrame:
    """Metric table of the partitions that the centres of each K make of ``rows``."""
    assigned = rows.withColumn("__a", assign_all(models)(vector))
    labels = {k: f"__k{k}" for k in models}
    wide = materialize(assigned.select(row_id, vector, *[F.col("__a")[i].alias(c) for i, c in enumerate(labels.values())]), "sweep")
    table = partition_metrics(wide, labels, vector).join(silhouette_squared(wide, vector, labels), "k", "left")
    return score_table(materialize(table.select("k", "inertia", "silhouette", "calinski_harabasz"), "k_metrics"))
