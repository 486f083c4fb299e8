"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with several probes and exact checks.

Pairs that share no bucket are compared too, in one bucket for all vectors of a label, so that no link is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .graph import components

TABLES = 8
SEED = 93
QUERY_ROWS = 512
OTHER_ROWS = 4096
HOT_BUCKET = 20_000  # vectors that a task compares at once
REST = np.iinfo(np.int64).max  # code of the bucket that holds all vectors of a label, for pairs without a common code
OWN, LEFT, RIGHT = 0, 1, 2  # the only block of its task, or the first or second of two


def _signs(width: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).choice([-1.0, 1.0], (tables, 2, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, a power of two wide."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def probe_codes(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """(rows, 3 tables) bucket codes: in each table two rotations, with the nearest vertex of the cross-polytope of both,
    and the second nearest of one or the other."""
    n, dims = unit.shape
    width = 1 << max(0, dims - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dims] = unit
    signs = _signs(width, tables)
    out = np.empty((n, tables, 3), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        codes = []
        for r in range(2):
            x = padded
            for s in range(3):
                x = _hadamard(x * signs[t, r, s])
            size = np.abs(x)
            first = size.argmax(axis=1)
            nearest = 2 * first + (x[rows, first] < 0)
            size[rows, first] = -1
            second = size.argmax(axis=1)
            codes.append((nearest, 2 * second + (x[rows, second] < 0)))
        (a, a2), (b, b2) = codes
        for i, (u, v) in enumerate(((a, b), (a2, b), (a, b2))):
            out[:, t, i] = (t * 2 * width + u) * 2 * width + v
    return out.reshape(n, 3 * tables)


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each length of vector."""
    size = np.diff(column.offsets.to_numpy())
    flat, start = column.flatten().to_numpy().astype(np.float64), np.cumsum(size) - size
    out = []
    for dims in np.unique(size):
        rows = np.flatnonzero(size == dims)
        x = flat[start[rows][:, None] + np.arange(dims)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest, so squares neither vanish nor overflow
        out.append((rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _coded(tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, 3 * tables), np.int64)
            for at in range(0, batch.num_rows, 4096):
                for rows, unit in _units(batch.column("v").slice(at, 4096)):
                    codes[at + rows] = probe_codes(unit, tables)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return run


def _links(table: pa.Table, threshold: float, tables: int) -> pa.RecordBatch:
    """For each vector of complete buckets with a link: its links by number of vectors, and a vector it is connected to."""
    column = lambda k: table[k].combine_chunks().to_numpy(zero_copy_only=False)
    bucket, salt, code, rep, copies, side = (column(k) for k in ("bucket", "salt", "code", "rep", "copies", "side"))
    edge = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])])
    links, label = np.zeros(len(rep), np.int64), rep.copy()
    vectors = table["v"].combine_chunks()
    for a, b in zip(edge, np.r_[edge[1:], len(rep)]):
        if b - a < 2:
            continue
        (_, unit), = _units(vectors.slice(a, b - a))
        alone = side[a] == OWN
        queries, others = (np.arange(b - a),) * 2 if alone else (np.flatnonzero(side[a:b] == k) for k in (LEFT, RIGHT))
        codes: dict[int, np.ndarray] = {}
        for at, to in product(range(0, len(queries), QUERY_ROWS), range(0, len(others), OTHER_ROWS)):
            own, against = queries[at : at + QUERY_ROWS], others[to : to + OTHER_ROWS]
            near = (unit[own] @ unit[against].T >= threshold) & (own[:, None] != against)
            q, other = np.nonzero(near)
            if not len(q):
                continue
            q, other = own[q], against[other]
            missing = [i for i in np.unique(np.r_[q, other]) if i not in codes]
            if missing:
                codes |= zip(missing, probe_codes(unit[missing], tables))
            # a pair counts in the first bucket that it shares
            first = np.empty(len(q), np.int64)
            for i in range(0, len(q), 1 << 14):
                x, y = (np.array([codes[j] for j in z[i : i + (1 << 14)]]) for z in (q, other))
                first[i : i + (1 << 14)] = _first_shared(x, y)
            here = first == code[a]
            np.add.at(links, a + q[here], copies[a + other[here]])
            if not alone:
                np.add.at(links, a + other[here], copies[a + q[here]])
            np.minimum.at(label, a + q, rep[a + other])
            np.minimum.at(label, a + other, rep[a + q])
    used = np.flatnonzero((links > 0) | (label != rep))
    return pa.RecordBatch.from_arrays([pa.array(x[used]) for x in (rep, label, links)], ["a", "b", "n"])


def _first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest code that both rows of codes hold, ``REST`` if there is none."""
    both = np.full(len(x), REST)
    for j in range(x.shape[1]):
        shared = (y == x[:, j : j + 1]).any(axis=1)
        both = np.where(shared, np.minimum(both, x[:, j]), both)
    return both


def _search(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                key = np.column_stack([batch["bucket"].to_numpy(), batch["salt"].to_numpy()])
                same = (key == key[-1]).all(axis=1)
                cut = len(key) - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield _links(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]), threshold, tables)
                    held = [batch.slice(cut)]
        if held:
            yield _links(pa.Table.from_batches(held), threshold, tables)

    return run


def _sound(x: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(x, lambda c: c != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", tables: int = TABLES, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector.

    Vectors of one label and one length are linked where their cosine, in double precision, is ``threshold`` or more,
    whether they meet in a bucket or not; the work grows with the square of the different vectors of a label.
    Equal vectors are searched once and count as often as they come.  ``component_id`` is the smallest vec_id reachable,
    ``kept`` says that it is the vector's own.  Vectors without a label, null, zero or with a null or non-finite component
    link with nothing, nor do rows with a null vec_id, which get a null component and are kept.  An empty table gives an
    empty result; other columns are not looked at.
    """
    key = [F.col(label).cast("string"), F.size(embedding), F.col(embedding)]
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & _sound(F.col(embedding)), F.xxhash64(*key)).alias("h"), F.xxhash64(F.lit(1), *key).alias("h2"), F.xxhash64(*key[:2]).alias("label"), F.col(embedding).alias("v"))
    named = rows.where("h is not null")
    classes = named.groupBy("h", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = materialize(classes.mapInArrow(_coded(tables), f"{_ddl(classes)}, codes array<long>"), "classes")
    dealt = classes.select("rep", "copies", "v", "label", F.explode(F.concat("codes", F.array(F.lit(int(REST))))).alias("code")).withColumn("bucket", F.xxhash64("label", "code"))
    hot = dealt.groupBy("bucket").count().where(F.col("count") > hot_bucket).select("bucket", F.ceil(2 * F.col("count") / hot_bucket).alias("parts"))
    # a large bucket is cut into blocks of half that size, and every pair of blocks is one task's
    dealt = dealt.join(hot, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    side = F.when(F.col("block") == F.col("other"), OWN).when(F.col("block") < F.col("other"), LEFT).otherwise(RIGHT)
    dealt = dealt.select("bucket", (F.least("block", "other") * F.col("parts") + F.greatest("block", "other")).alias("salt"), "code", "rep", "copies", side.alias("side"), "v")
    dealt = dealt.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "rep")
    found = materialize(dealt.mapInArrow(_search(threshold, tables), "a long, b long, n long"), "links")
    roots = components(found.select("a", "b"), "a", "b")
    known = classes.select("h", "h2", "rep", "copies").join(found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n")), "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    known = known.select("h", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "rep").alias("root"))
    out = rows.select("vec_id", "h", "h2").join(known, ["h", "h2"], "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"), F.col("vec_id").eqNullSafe(F.coalesce("root", "vec_id")).alias("kept"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
