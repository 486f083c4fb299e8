"""Truncated singular value decomposition and the 2-D projection.

A randomised range finder: a few directions are multiplied by the rows, and a pass returns two small things of the products
Y = A Q: the triangular factor R of a QR decomposition that is folded in a tree, and the sums Z = A'Y.  As (Y R^-1)'A is
(Z R^-1)', one pass gives the decomposition of the rows within the space that Q spans, and an orthogonal basis of Z is the
Q of the next pass.  Where Q has as many directions as there are columns, the first pass is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.vectors import entries

# Fixed value: dimensions kept of a wide text block.
SVD_DIMENSIONS = 256
OVERSAMPLING = 64  # directions beyond those wanted
POWER_PASSES = 4  # passes after the first, each of which sharpens the directions
CELLS = 1 << 21  # numbers that a task multiplies at once
PIECE_ROWS = 512  # rows of Z that travel together
FOLDS = 64  # tasks of the lower level of the tree


def _products(column: pa.Array, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """(rows, rows times q, the entries) of the vectors of a batch, dense and sparse ones apart, in bounded parts."""
    if not len(column):
        return
    present = np.asarray(column.is_valid())
    kind = np.where(present, np.asarray(column.field("type").fill_null(1)), -1)
    n, width = q.shape
    for sparse in (False, True):
        rows = np.flatnonzero(kind == (0 if sparse else 1))
        own = column.take(pa.array(rows))
        values, indices = own.field("values"), own.field("indices")
        lengths = np.asarray(values.value_lengths().fill_null(0)).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        if not sparse and (lengths != n).any():
            raise ValueError(f"vectors of {sorted(set(lengths[lengths != n]))[:3]} components among those of {n}")
        ends = np.cumsum(lengths)
        at = 0
        while at < len(rows):
            room = (ends[at - 1] if at else 0) + max(1, CELLS // (width if sparse else 1))
            to = max(at + 1, int(np.searchsorted(ends, room, "right")))
            v = values.slice(at, to - at).flatten().to_numpy(zero_copy_only=False)
            if sparse:
                i = indices.slice(at, to - at).flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(to - at), lengths[at:to])
                y = np.zeros((to - at, width))
                if len(v):
                    some = np.flatnonzero(lengths[at:to])
                    y[some] = np.add.reduceat(v[:, None] * q[i], (ends[at:to] - lengths[at:to] - (ends[at] - lengths[at]))[some])
                yield rows[at:to], y, (owner, i, v)
            else:
                v = v.reshape(to - at, n)
                yield rows[at:to], v @ q, (v,)
            at = to


def _add(z: np.ndarray, y: np.ndarray, held: tuple) -> None:
    """Add the entries' transpose times y."""
    if len(held) == 1:
        z += held[0].T @ y
        return
    owner, i, v = held
    if len(v):
        order = np.argsort(i, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(i[order]) > 0])
        z[i[order][starts]] += np.add.reduceat(v[order, None] * y[owner[order]], starts)


def _fold(r: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([r, more]), mode="r")


def _pass(rows: DataFrame, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(R, Z) of the rows times ``q``; the driver gets these two, whatever the number of rows and tasks."""
    n, width = q.shape
    sent = rows.sparkSession.sparkContext.broadcast(q)
    schema = "piece int, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, r, z, seen = sent.value, np.zeros((0, width)), np.zeros((n, width)), 0
        for batch in batches:
            for part, y, held in _products(batch.column(0), q):
                r, seen = _fold(r, y), seen + len(part)
                _add(z, y, held)
        if seen:
            yield _piece(-1 - TaskContext.get().partitionId() % FOLDS, np.vstack([r, np.zeros((max(0, width - len(r)), width))]))
            for i in range(0, n, PIECE_ROWS):
                if z[i : i + PIECE_ROWS].any():
                    yield _piece(i // PIECE_ROWS, z[i : i + PIECE_ROWS])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = np.frombuffer(data.as_buffer()).reshape(-1, width)
                if piece not in held:
                    held[piece] = block.copy()
                elif piece < 0:
                    held[piece] = _fold(held[piece], block)
                else:
                    held[piece] += block
        for piece, block in held.items():
            yield _piece(piece, block)

    found = rows.mapInArrow(run, schema).repartition("piece").mapInArrow(add, schema).collect()
    r, z = np.zeros((width, width)), np.zeros((n, width))
    for piece, data in sorted((row.piece, bytes(row.data)) for row in found):
        block = np.frombuffer(data).reshape(-1, width)
        if piece < 0:
            r = _fold(r, block)
        else:
            z[piece * PIECE_ROWS : piece * PIECE_ROWS + len(block)] = block
    sent.unpersist()
    return r, z


def _piece(number: int, block: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([np.ascontiguousarray(block).tobytes()], pa.binary())], ["piece", "data"])


@dataclass(frozen=True)
class Svd:
    """Right singular vectors (one column each) and singular values of the uncentered matrix."""

    components: np.ndarray
    singular_values: np.ndarray

    def transform(self, df: DataFrame, row_id: str, features: str = "features", output: str = "reduced") -> DataFrame:
        """(row_id, output): the rows times the components, as ARRAY<DOUBLE>; null for a null vector."""
        sent = df.sparkSession.sparkContext.broadcast(self.components)
        k = self.components.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, y, _ in _products(batch.column(1), sent.value):
                    offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * k)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(part)), pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))], [row_id, output])
                empty = batch.column(0).filter(batch.column(1).is_null())
                if len(empty):
                    yield pa.RecordBatch.from_arrays([empty, pa.nulls(len(empty), pa.list_(pa.float64()))], [row_id, output])

        schema = T.StructType([df.schema[row_id], T.StructField(output, T.ArrayType(T.DoubleType()))])
        return df.select(row_id, entries(df, features).alias("__v")).mapInArrow(run, schema)


def fit_svd(df: DataFrame, k: int, row_id: str, features: str = "features", passes: int = POWER_PASSES, seed: int = 1) -> Svd:
    """The leading ``k`` singular vectors and values, in one pass over the rows and at most ``passes`` more.

    Null vectors are left out; components beyond the rank have the singular value 0 and an arbitrary direction.
    Only n x (k + ``OVERSAMPLING``) numbers reach the driver and the tasks, n being the number of columns.  The passes end
    early where Q spans all columns, or where the wanted singular values have settled.  The sign of each component is
    fixed by its largest-magnitude loading.
    """
    rows = df.select(entries(df, features).alias("__v")).where("__v is not null")
    first = rows.select(F.coalesce(F.col("__v.size"), F.size("__v.values")).alias("n")).first()
    n = first.n if first else 0
    k, width = min(k, n), min(n, k + OVERSAMPLING)
    if not k:
        return Svd(np.zeros((n, 0)), np.zeros(0))
    q = np.eye(n) if width == n else np.linalg.qr(np.random.default_rng(seed).normal(size=(n, width)))[0]
    values = np.zeros(k)
    for _ in range(1 + passes):
        r, z = _pass(rows, q)
        # directions that the rows do not have are left out of the inverse
        u, s, vt = np.linalg.svd(r)
        back = np.divide(1, s, out=np.zeros_like(s), where=s > s.max(initial=0.0) * 1e-12)
        inner, found, right = np.linalg.svd((u * back) @ vt @ z.T, full_matrices=False)
        settled = np.abs(found[:k] - values).max() <= 1e-9 * max(found.max(initial=0.0), 1e-300)
        values, v = found[:k], right[:k].T
        if width == n or settled:
            break
        q = np.linalg.qr(z)[0]
    signs = np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return Svd(v * np.where(signs == 0, 1.0, signs), values)


def project_2d(df: DataFrame, row_id: str, features: str = "features") -> DataFrame:
    """(row_id, proj_x, proj_y): the two leading components of every row."""
    reduced = fit_svd(df, 2, row_id, features).transform(df, row_id, features, "__p")
    return reduced.select(row_id, F.get("__p", F.lit(0)).alias("proj_x"), F.get("__p", F.lit(1)).alias("proj_y"))
