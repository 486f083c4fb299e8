"""K-means, mini-batch updates, cluster moments and centroid distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.vectors import distance
from ..session import work_folder
from . import blocks, lloyd
from .skew import lookup_join

# Restarts of a final fit and of a fit within the sweep over K.
FINAL_RESTARTS = 20
SWEEP_RESTARTS = 10
CENTER_ROWS = 2048  # centres in one matrix product
CHUNK_VALUES = 1 << 24  # numbers of the centres that are sent at once: 128 MB


def fit_kmeans(df: DataFrame, k: int, row_id: str = "row_id", vector: str = "vector", restarts: int = FINAL_RESTARTS, seed: int = 42) -> np.ndarray:
    """Centres of the least cost of several seeded runs, which share their passes over ``df``; the caller should cache it."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return lloyd.best_fits(df, [k], lloyd.spread_starts(df, [k], restarts, row_id, vector, seed), vector)[k].centers


def nearest_center(centers: np.ndarray, ids: list[int] | None = None):
    """Arrow function ARRAY<DOUBLE> -> id of the nearest centre (lowest id on ties)."""
    order = np.argsort(ids) if ids is not None else np.arange(len(centers))
    table = np.asarray(centers, dtype=float)[order]
    names = np.asarray(ids if ids is not None else range(len(centers)))[order]

    @F.pandas_udf(T.IntegerType())
    def assign(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype="int32")
        x, middle = np.stack(vectors.to_numpy()), table.mean(axis=0)
        d2 = blocks.squared_distances(x - middle, table - middle)
        return pd.Series(names[d2.argmin(axis=1)].astype("int32"))

    return assign


def cluster_moments(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Per cluster: n, mean vector and within-cluster sum of squares, in one combined pass.

    Vectors are summed map-side; only one buffer per cluster and task moves.  A column of the vector type is taken as it
    is, so of sparse ones only the stored entries are looked at.
    """
    stored = isinstance(df.schema[vector].dataType, VectorUDT)
    stats = Summarizer.metrics("mean", "variance").summary(F.col(vector) if stored else array_to_vector(F.col(vector)))
    spread = F.aggregate(vector_to_array("__s.variance"), F.lit(0.0), lambda a, b: a + b)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"), stats.alias("__s"))
        .select(
            *keys,
            "n",
            vector_to_array("__s.mean").alias("center"),
            F.when(F.col("n") > 1, spread * (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("within"),
        )
    )


def centroid_distance(df: DataFrame, centroids: DataFrame, cluster: str = "cluster_id", vector: str = "vector") -> DataFrame:
    """Distance of each row to the centre of its own cluster; the others are never looked at."""
    lookup = centroids.select(cluster, F.col("center").alias("__center"))
    joined = lookup_join(df, lookup, [cluster], max_rows=20_000)
    return joined.withColumn("cluster_dist", distance(F.col(vector), F.col("__center"))).drop("__center")


def _nearer(ids: np.ndarray, centers: np.ndarray):
    """Arrow function: the nearest of some centres, or what was found before if that is nearer; ties to the lowest id."""
    order = np.argsort(ids)
    ids, centers = ids[order], centers[order]

    @F.pandas_udf("d double, id long")
    def better(vectors: pd.Series, best: pd.DataFrame) -> pd.DataFrame:
        d, found = best["d"].to_numpy(float, na_value=np.inf).copy(), best["id"].to_numpy(float, na_value=np.inf).copy()
        known = np.flatnonzero(vectors.notna().to_numpy())
        if len(known):
            x = np.stack(vectors.to_numpy()[known])
            for low in range(0, len(centers), CENTER_ROWS):
                table = centers[low : low + CENTER_ROWS]
                middle = table.mean(axis=0)
                at = blocks.squared_distances(x - middle, table - middle).argmin(axis=1)
                exact, name = ((x - table[at]) ** 2).sum(axis=1), ids[low + at]
                nearer = (exact < d[known]) | ((exact == d[known]) & (name < found[known]))
                d[known[nearer]], found[known[nearer]] = exact[nearer], name[nearer]
        there = np.isfinite(found)
        return pd.DataFrame({"d": d, "id": pd.Series(np.where(there, found, 0).astype("int64"), dtype="Int64").mask(~there)})

    return better


def assign_nearest(df: DataFrame, centroids: DataFrame, vector: str = "vector", output: str = "cluster_id", chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """The id of the nearest of any number of centres beside each row, the lowest on ties, null without vector or centres.

    Rows do not move.  The centres (cluster_id, center) go to the tasks in chunks of ``chunk_values`` numbers, each compared
    by matrix products block by block, so what is sent or held at once does not grow with their number.
    """
    sizes = centroids.agg(F.count("*").alias("n"), F.max(F.size("center")).alias("width")).first()
    chunks = -(-sizes.n * (sizes.width or 0) // chunk_values) or 1
    best = F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast("long").alias("id"))
    df = df.withColumn("__best", best)
    for c in range(chunks):
        part = centroids.where(F.pmod(F.xxhash64("cluster_id"), F.lit(chunks)) == c).select("cluster_id", "center").collect()
        if part:
            nearer = _nearer(np.array([r.cluster_id for r in part]), np.array([r.center for r in part], dtype=float))
            df = df.withColumn("__best", nearer(F.col(vector), F.col("__best")))
    return df.withColumn(output, F.col("__best.id").cast(centroids.schema["cluster_id"].dataType)).drop("__best")


def batch_update(centers: np.ndarray, weights: np.ndarray, batch: DataFrame, vector: str = "vector", decay: float = 1.0):
    """One mini-batch step: assign the batch, then move each centre by the batch mean of its rows.

    The batch is reduced to one mean per centre before it reaches the driver.
    """
    assigned = batch.select(F.col(vector).alias("__x"), nearest_center(centers)(F.col(vector)).alias("cluster_id"))
    centers, weights = centers.copy(), weights.copy()
    for row in cluster_moments(assigned, ["cluster_id"], "__x").collect():  # at most k rows
        c, kept = row.cluster_id, weights[row.cluster_id] * decay
        total = kept + row.n
        centers[c] = (centers[c] * kept + np.array(row.center) * row.n) / total
        weights[c] = total
    return centers, weights


def initial_centers(df: DataFrame, k: int, row_id: Column, vector: str = "vector", seed: int = 42) -> np.ndarray:
    """``k`` rows, the first by a digest of id and seed."""
    rows = df.select(F.col(vector).alias("v")).orderBy(F.md5(F.concat_ws(":", row_id, F.lit(seed))), row_id).limit(k).collect()
    return np.array([r.v for r in rows], dtype=float)


def fit_minibatch(df: DataFrame, k: int, row_id: str, vector: str = "vector", batches: int = 8, epochs: int = 3, seed: int = 42, restarts: int = 1) -> np.ndarray:
    """Mini-batch k-means over batches split by a digest of the id.

    The batches are written as folders of one table, so that an epoch reads every
    row once, for all restarts together.
    """
    digest = F.md5(F.concat_ws(":", row_id, F.lit(seed)))
    slot = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % batches).cast("int")
    folder = work_folder(df.sparkSession, "batches")
    df.select(row_id, vector, slot.alias("__slot")).write.partitionBy("__slot").parquet(folder)
    df = df.sparkSession.read.parquet(folder)
    runs = [initial_centers(df, k, F.col(row_id), vector, seed + r) for r in range(restarts)]
    weights = [np.zeros(len(c)) for c in runs]
    for _ in range(epochs):
        for b in range(batches):
            _update_all(runs, weights, df.where(F.col("__slot") == b), vector)
    if restarts == 1:
        return runs[0]
    costs = df.agg(*[F.sum(c).alias(f"c{i}") for i, c in enumerate(_costs(runs, vector))]).first()
    return runs[int(np.argmin([c or 0.0 for c in costs]))]


def _nearest_all(runs: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, runs) nearest centre of each run, and the squared distance to it."""
    d2 = [np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1) for centers in runs]
    return np.stack([d.argmin(axis=1) for d in d2], axis=1), np.stack([d.min(axis=1) for d in d2], axis=1)


def _update_all(runs: list[np.ndarray], weights: list[np.ndarray], batch: DataFrame, vector: str) -> None:
    """One mini-batch step of all runs, in one pass over the batch; the lists are changed in place."""
    tables = [c.copy() for c in runs]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def assign(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(_nearest_all(tables, np.stack(vectors.to_numpy()))[0].astype("int32")) if len(vectors) else [], dtype=object)

    long = batch.select(F.col(vector).alias("__x"), assign(F.col(vector)).alias("__a")).select("__x", F.posexplode("__a").alias("run", "cluster_id"))
    for row in cluster_moments(long, ["run", "cluster_id"], "__x").collect():  # at most k rows a run
        r, c = row.run, row.cluster_id
        total = weights[r][c] + row.n
        runs[r][c] = (runs[r][c] * weights[r][c] + np.array(row.center) * row.n) / total
        weights[r][c] = total


def _costs(runs: list[np.ndarray], vector: str) -> list[Column]:
    """Squared distance of a row to its nearest centre, by run."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def cost(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(_nearest_all(runs, np.stack(vectors.to_numpy()))[1]) if len(vectors) else [], dtype=object)

    both = cost(F.col(vector))
    return [both[i] for i in range(len(runs))]


def inertia(df: DataFrame, centers: np.ndarray, vector: str = "vector") -> float:
    """Sum of squared distances to the nearest centre."""

    @F.pandas_udf(T.DoubleType())
    def cost(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype="float64")
        x = np.stack(vectors.to_numpy())
        return pd.Series(np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1).min(axis=1))

    return df.agg(F.sum(cost(F.col(vector)))).first()[0] or 0.0
