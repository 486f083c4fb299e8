"""Exact top-k by integer inner product: every query against every vector, term at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

QUERY_ROWS = 512
BLOCK_ROWS = 8192


def weights(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, w): components times ``scale``, rounded down, as whole numbers.

    Rows whose id or vector is null, or whose vector holds null or a component that is not finite, are left out.
    """
    x = F.col(embedding)
    sound = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & sound)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("w"))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors as postings: by term the rows that have it and their weights."""
    ids, lists, n = [], [], 0

    def block() -> pa.RecordBatch:
        own = np.concatenate(ids)
        size = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists])
        value = np.concatenate([x.flatten().to_numpy() for x in lists]).astype(np.int64)
        row = np.repeat(np.arange(len(own)), size)
        term = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
        used = np.flatnonzero(value)
        used = used[np.argsort(term[used], kind="stable")]
        ends = np.cumsum(np.bincount(term[used], minlength=int(size.max(initial=0))))
        return pa.RecordBatch.from_arrays([pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in ((own, np.int64), (ends, np.int64), (row[used], np.int32), (value[used], np.int64))], ["ids", "ends", "rows", "values"])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            ids.append(part.column(0).to_numpy())
            lists.append(part.column(1))
            n += part.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                ids, lists, n = [], [], 0
    if n:
        yield block()


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        above, level = np.flatnonzero(score > bar), np.flatnonzero(score == bar)
        room = k - len(above)
        if len(level) > room:
            level = level[np.lexsort((level, ids[level]))[:room]]
        return np.r_[above, level]
    return np.arange(len(score))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, ends, rows, values = (np.frombuffer(batch[c][i].as_py(), t) for c, t in (("ids", np.int64), ("ends", np.int64), ("rows", np.int32), ("values", np.int64)))
                starts = np.r_[0, ends[:-1]].astype(np.int64)
                whole = ends - starts == len(ids)
                lists = [(values[a:b], None if w else rows[a:b]) for a, b, w in zip(starts, ends, whole)]
                found = []
                for query in batch["queries"][i].as_py():
                    score = np.zeros(len(ids), np.int64)
                    for term, weight in enumerate(query["w"][: len(lists)]):
                        if weight:
                            value, place = lists[term]
                            if place is None:
                                score += weight * value
                            else:
                                score[place] += weight * value
                    other = np.flatnonzero(ids != query["query_id"])
                    best = other[_best(score[other], ids[other], k)]
                    found.append((np.full(len(best), query["query_id"]), np.full(len(best), query["query_key"]), ids[best], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], ["query_id", "query_key", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query, ties to smaller vec_id.

    Both tables are (vec_id, w) as made by ``weights``.  A query meets every candidate but those of its own vec_id; equal
    queries count once.  A component that one vector lacks counts as zero there, so vectors of several lengths and empty
    ones have a score too.  Fewer candidates than k give fewer rows, and an empty table none.  Blocks of queries meet
    blocks of vectors; of each pair of blocks only k rows a query go on.
    """
    blocks = materialize(candidates.mapInArrow(_postings, "ids binary, ends binary, rows binary, values binary"), "postings")
    asked = materialize(queries.distinct().select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "w").alias("query_key"), "w"), "queries")
    parts = -(-asked.count() // QUERY_ROWS) or 1
    sets = asked.groupBy(F.pmod("query_key", F.lit(parts)).cast("int").alias("part")).agg(F.collect_list(F.struct("query_id", "query_key", "w")).alias("queries"))
    pairs = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(sets, "part")
    found = pairs.select("ids", "ends", "rows", "values", "queries").mapInArrow(_search(k), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
