"""Centroids kept up to date as batches of vectors arrive."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.vectors import as_double
from ..operators.cluster import batch_update, initial_centers

STATE = "batch long, cluster_id int, weight double, center array<double>"


def write_state(spark: SparkSession, path: str, batch: int, centers: np.ndarray, weights: np.ndarray) -> None:
    """The centres after a batch; without any yet, one row that only says that the batch is done."""
    rows = [(batch, i, float(w), [float(x) for x in c]) for i, (c, w) in enumerate(zip(centers, weights))]
    spark.createDataFrame(rows or [(batch, -1, 0.0, [])], STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch:012d}")


def read_state(spark: SparkSession, path: str, before: int | None = None):
    """Centres and weights after the last batch (before batch ``before`` if given): k rows, or none yet."""
    if before is not None:  # every batch writes its state, so they are numbered without gaps
        path = f"{path}/batch={before - 1:012d}"
    state = spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(path)
    last = state.agg(F.max("batch")).scalar()
    rows = state.where((F.col("batch") == last) & (F.col("cluster_id") >= 0)).orderBy("cluster_id").collect()
    centers = np.array([r.center for r in rows], dtype=float) if rows else np.zeros((0, 0))
    return centers, np.array([r.weight for r in rows], dtype=float)


def track_centroids(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    state: str,
    checkpoint: str,
    k: int,
    row_id: str,
    vector: str,
    decay: float = 1.0,
    seed: int = 42,
    max_files: int | None = None,
) -> StreamingQuery:
    """Update ``k`` centres with every arriving batch; each batch's state is written under its own number.

    A batch that is replayed after a failure starts from the state before it and overwrites its own folder, so it counts
    once.  Rows without a vector, or with null or non-finite components, take no part; a batch without others
    carries the state over.  Until ``k`` different vectors have arrived there are fewer centres, one each.
    """

    def step(batch: DataFrame, number: int) -> None:
        x = F.col("__x")
        sound = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
        rows = batch.select(F.col(row_id), as_double(F.col(vector)).alias("__x")).where(sound).persist()
        try:
            session = batch.sparkSession
            centers, weights = (np.zeros((0, 0)), np.zeros(0)) if number == 0 else read_state(session, state, before=number)
            if len(centers) < k:  # the batches so far had too few different rows
                known = session.createDataFrame([([float(v) for v in c],) for c in centers], "__x array<double>")  # fewer than k
                fresh = rows.join(F.broadcast(known), "__x", "left_anti").groupBy("__x").agg(F.min(row_id).alias(row_id))
                more = initial_centers(fresh, k - len(centers), F.col(row_id), "__x", seed)
                if len(more):
                    centers = np.vstack([centers, more]) if len(centers) else more
                    weights = np.r_[weights, np.zeros(len(more))]
            if len(centers):
                centers, weights = batch_update(centers, weights, rows, "__x", decay)
            write_state(session, state, number, centers, weights)
        finally:
            rows.unpersist()

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
