"""Vectors packed into bounded blocks, so that pairs of rows are compared inside numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BLOCK_ROWS = 1024


def pack_sample(sample: DataFrame, row_id: str, vector: str, labels: list[str], blocks: int) -> DataFrame:
    """(block, ids, flat vectors, flat labels); the caller bounds the number of rows."""
    slot = F.pmod(F.xxhash64(row_id), F.lit(blocks)).cast("int")
    member = F.struct(
        F.col(row_id).alias("id"), F.col(vector).alias("v"), F.array(*[F.col(c).cast("int") for c in labels]).alias("l")
    )
    grouped = sample.groupBy(slot.alias("block")).agg(F.collect_list(member).alias("m"))
    return grouped.select(
        "block",
        F.transform("m", lambda m: m["id"]).alias("ids"),
        F.flatten(F.transform("m", lambda m: m["v"])).alias("vectors"),
        F.flatten(F.transform("m", lambda m: m["l"])).alias("labels"),
    )


def matrix(flat, rows: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(rows, -1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances through one matrix product; tiny negatives from rounding become 0."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d2, 0.0, out=d2)
