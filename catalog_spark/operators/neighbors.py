"""Exact nearest neighbours within each cluster.

Rows are compared in bounded blocks, never as a join of all row pairs:

1. Exact copies of a vector are searched once, and only as many of them as can
   show up in an answer stay candidates.
2. Pivots cut every large cluster into cells; a cell, ordered by distance to its
   pivot, is cut into blocks of at most ``BLOCK_ROWS`` rows.  The cut follows a
   range partitioning by (cluster, cell, distance, id), so a cluster or cell that
   holds most of the rows is spread over many tasks.
3. Each block finds neighbours in itself, which bounds how far its rows still
   have to look.
4. Only pairs of blocks that the triangle inequality cannot rule out are
   compared.  Nothing is capped: a pair is left out only if it cannot matter.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .blocks import matrix, squared_distances
from .skew import HOT_ROWS, lookup_join

BLOCK_ROWS = 1024
PIVOTS_PER_CLUSTER = 64
MAX_PIVOTS = 20_000
# Slack for distances that were computed along different routes.
ROUNDING = 1e-9

BLOCK = "block long, cluster long, cell int, lo double, hi double, ids array<long>, items array<string>, search array<boolean>, vectors array<double>"
FOUND = "id long, dist double, nn long, item string"


def _pivots(rows: DataFrame, block_rows: int, per_cluster: int, limit: int) -> dict[int, np.ndarray]:
    """Hash sample of rows for each cluster larger than a block, the largest first, ``limit`` rows in all."""
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
    budget, shares = limit, []
    for r in sizes.orderBy(F.col("n").desc(), "cluster").limit(limit // 2).collect():
        share = min(-(-r.n // block_rows), per_cluster, budget)
        if share < 2:
            break
        shares.append((r.cluster, share))
        budget -= share
    if not shares:
        return {}
    wanted = rows.sparkSession.createDataFrame(shares, "cluster long, p long")
    order = Window.partitionBy("cluster").orderBy(F.xxhash64("id"), "id")
    picked = (
        rows.join(F.broadcast(wanted), "cluster")  # at most limit / 2 rows
        .select("cluster", "p", "vector", F.row_number().over(order).alias("r"))
        .where((F.col("r") <= per_cluster) & (F.col("r") <= F.col("p")))
    )
    found: dict[int, list] = {}
    for r in picked.select("cluster", "vector").collect():
        found.setdefault(r.cluster, []).append(r.vector)
    return {c: np.unique(np.array(v, dtype=float), axis=0) for c, v in found.items()}


def _place(rows: DataFrame, pivots) -> DataFrame:
    """Add cell (nearest pivot of the own cluster, -1 without pivots) and the distance to it."""

    def place(batches):
        for pdf in batches:
            cell = np.full(len(pdf), -1, dtype="int32")
            far = np.zeros(len(pdf))
            for c, at in pdf.groupby("cluster").indices.items():
                table = pivots.value.get(c)
                if table is None:
                    continue
                x = np.stack(pdf["vector"].to_numpy()[at])
                nearest = squared_distances(x, table).argmin(axis=1)
                cell[at] = nearest
                far[at] = np.sqrt(((x - table[nearest]) ** 2).sum(axis=1))
            yield pdf.assign(cell=cell, far=far)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(place, f"{fields}, cell int, far double")


def _pack(rows: DataFrame, block_rows: int) -> DataFrame:
    """Runs of one cell within a range partition, cut into blocks.  A block is named by its first row."""

    def pack(batches):
        for pdf in batches:
            out = []
            change = (pdf["cluster"].diff().ne(0) | pdf["cell"].diff().ne(0)).to_numpy()
            starts = list(np.flatnonzero(change)) or [0]
            for a, b in itertools.pairwise([*starts, len(pdf)]):
                for s in range(a, b, block_rows):
                    part = pdf.iloc[s : min(s + block_rows, b)]
                    out.append(
                        (
                            part["id"].iloc[0], part["cluster"].iloc[0], part["cell"].iloc[0], part["far"].min(), part["far"].max(),
                            part["id"].to_numpy(), part["item"].to_numpy(), part["search"].to_numpy(),
                            np.concatenate(part["vector"].to_numpy()),
                        )
                    )
            names = ["block", "cluster", "cell", "lo", "hi", "ids", "items", "search", "vectors"]
            yield pd.DataFrame(out, columns=names)

    order = ["cluster", "cell", "far", "id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pack, BLOCK)


def _search(queries: np.ndarray, query_ids, points: np.ndarray, point_ids, items, n: int) -> pd.DataFrame:
    """The ``n`` nearest points of each query by (distance, id), the query itself included.

    A matrix product narrows each row to the points within rounding error of the
    n-th; those few get their exact distances.
    """
    d2 = squared_distances(queries, points)
    last = min(n, d2.shape[1]) - 1
    cut = np.partition(d2, last, axis=1)[:, last]
    norms = (queries * queries).sum(1)[:, None] + (points * points).sum(1)[None, :]
    q, p = np.nonzero(d2 <= cut[:, None] + 1e-12 * norms)
    exact = np.sqrt(((queries[q] - points[p]) ** 2).sum(axis=1))
    order = np.lexsort((point_ids[p], exact, q))
    q, p, exact = q[order], p[order], exact[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < n
    q, p = q[keep], p[keep]
    return pd.DataFrame({"id": query_ids[q], "dist": exact[keep], "nn": point_ids[p], "item": items[p]})


def _own_block(blocks: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Neighbours within the own block, and per block how far the n-th of them is at most."""

    def search(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                mask = np.asarray(r.search, dtype=bool)
                if not mask.any():
                    continue
                ids, x = np.asarray(r.ids), matrix(r.vectors, len(r.ids))
                found = _search(x[mask], ids[mask], x, ids, np.asarray(r.items, dtype=object), n)
                reach = found["dist"].groupby(found["id"]).transform("max").max() if len(ids) >= n else np.inf
                yield found.assign(block=r.block, reach=reach)

    found = materialize(blocks.mapInPandas(search, f"{FOUND}, block long, reach double"), "own")
    return found.drop("block", "reach"), found.groupBy("block").agg(F.max("reach").alias("reach"))


def _visits(blocks: DataFrame, reach: DataFrame, pivots, n: int) -> DataFrame:
    """(block, other): pairs of different blocks of a cluster that may hold closer neighbours."""
    meta = blocks.select("block", "cluster", "cell", "lo", "hi", F.size("ids").alias("rows"))
    cells = meta.where("cell >= 0").groupBy("cluster", "cell").agg(F.max("hi").alias("radius"), F.sum("rows").alias("rows"))
    sized = cells.collect() if pivots.value else []  # no more rows than pivots
    known: dict[int, tuple] = {}
    for c, group in itertools.groupby(sorted(sized, key=lambda r: (r.cluster, r.cell)), key=lambda r: r.cluster):
        group = list(group)
        index = np.array([r.cell for r in group])
        known[c] = (index, np.array([r.radius for r in group]), np.array([r.rows for r in group]))

    def reachable(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                if r.cell < 0:
                    out.append((r.block, r.cluster, r.cell, r.lo, r.hi, r.reach, -1, 0.0))
                    continue
                index, radius, rows = known[r.cluster]
                table = pivots.value[r.cluster]
                between = np.sqrt(((table[index] - table[r.cell]) ** 2).sum(axis=1))
                # A cell with enough rows bounds the n-th distance from outside, too.
                enough = rows >= n
                bound = (r.hi + between + radius)[enough].min() if enough.any() else np.inf
                bound = min(r.reach, bound)
                slack = ROUNDING * (1.0 + between + r.hi + radius)
                near = (between - r.hi - radius <= bound + slack) | (index == r.cell)
                out += [(r.block, r.cluster, r.cell, r.lo, r.hi, bound, c, d) for c, d in zip(index[near], between[near])]
            names = ["block", "cluster", "cell", "lo", "hi", "bound", "to_cell", "between"]
            yield pd.DataFrame(out, columns=names)

    schema = "block long, cluster long, cell int, lo double, hi double, bound double, to_cell int, between double"
    looking = meta.join(reach, "block").mapInPandas(reachable, schema)
    other = meta.select(
        "cluster", F.col("cell").alias("to_cell"), F.col("block").alias("other"), F.col("lo").alias("o_lo"), F.col("hi").alias("o_hi")
    )
    # Same cell: the gap between the distance ranges; different cells: what the radii leave.
    ring = F.greatest(F.lit(0.0), F.col("o_lo") - F.col("hi"), F.col("lo") - F.col("o_hi"))
    apart = F.greatest(F.lit(0.0), F.col("between") - F.col("hi") - F.col("o_hi"))
    gap = F.when(F.col("cell") == F.col("to_cell"), ring).otherwise(apart)
    slack = ROUNDING * (F.lit(1.0) + F.col("between") + F.col("hi") + F.col("o_hi"))
    pairs = looking.join(other, ["cluster", "to_cell"])
    return pairs.where((F.col("block") != F.col("other")) & (gap <= F.col("bound") + slack)).select("block", "other")


def _other_blocks(blocks: DataFrame, visits: DataFrame, n: int) -> DataFrame:
    """Neighbours found in the visited blocks."""
    asking = blocks.select("block", F.col("ids").alias("q_ids"), F.col("search").alias("q_search"), F.col("vectors").alias("q_vectors"))
    asked = blocks.select(F.col("block").alias("other"), "ids", "items", "vectors")

    def search(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                mask = np.asarray(r.q_search, dtype=bool)
                x = matrix(r.q_vectors, len(r.q_ids))[mask]
                points = matrix(r.vectors, len(r.ids))
                yield _search(x, np.asarray(r.q_ids)[mask], points, np.asarray(r.ids), np.asarray(r.items, dtype=object), n)

    paired = visits.join(asked, "other").join(asking, "block")
    columns = ["q_ids", "q_search", "q_vectors", "ids", "items", "vectors"]
    return paired.select(*columns).mapInPandas(search, FOUND)


def nearest_in_cluster(
    df: DataFrame,
    row_id: str,
    cluster: str,
    vector: str,
    k: int = 3,
    item: str | None = None,
    block_rows: int = BLOCK_ROWS,
    pivots_per_cluster: int = PIVOTS_PER_CLUSTER,
    distinct_item: bool = False,
) -> DataFrame:
    """(row_id, rank, nn_id, nn_dist): the ``k`` nearest other rows of the same cluster.

    ``row_id`` and ``cluster`` are integers, ``vector`` is ARRAY<DOUBLE>.  Ties go
    to the smaller row id.  ``item`` is the id reported for a neighbour (the row id
    if not given); with ``distinct_item`` rows of the own item are no neighbours and
    every other item counts once, through its nearest row.
    """
    name = F.col(item or row_id).cast("string")
    rows = df.select(
        F.col(row_id).cast("long").alias("id"), F.col(cluster).cast("long").alias("cluster"), name.alias("item"), F.col(vector).alias("vector")
    )
    if distinct_item:
        return _distinct_items(rows, row_id, k, block_rows, pivots_per_cluster)
    lists = _lists(rows, k + 1, block_rows, pivots_per_cluster)
    others = F.slice(F.filter("found", lambda s: s["nn"] != F.col("id")), 1, k)
    ranked = _for_every_row(rows, lists).select("id", F.posexplode(others).alias("p", "s"))
    return ranked.select(
        F.col("id").alias(row_id), (F.col("p") + 1).alias("rank"), F.col("s.item").alias("nn_id"), F.col("s.dist").alias("nn_dist")
    )


def _lists(rows: DataFrame, n: int, block_rows: int, pivots_per_cluster: int) -> DataFrame:
    """(id, found): the ``n`` nearest rows, itself included, for the first row of each distinct vector of a cluster."""
    spark = rows.sparkSession
    same = Window.partitionBy("cluster", "vector").orderBy("id")
    # Rank <= n is applied before the shuffle too, so copies do not pile up in a task.
    ranked = rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= n)
    candidates = ranked.withColumn("search", F.col("r") == 1).drop("r")
    pivots = spark.sparkContext.broadcast(_pivots(candidates, block_rows, pivots_per_cluster, MAX_PIVOTS))
    blocks = materialize(_pack(_place(candidates, pivots), block_rows), "blocks")
    own, reach = _own_block(blocks, n)
    found = own.unionByName(_other_blocks(blocks, _visits(blocks, reach, pivots, n), n))
    best = Window.partitionBy("id").orderBy("dist", "nn")
    nearest = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n)
    return nearest.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dist", "nn", "item"))).alias("found"))


def _for_every_row(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """(id, found): copies take over the list of the first row with their vector."""
    groups = rows.groupBy("cluster", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    repeated = materialize(groups.where(F.col("copies") > 1), "copies")
    if repeated.isEmpty():
        return lists.select("id", "found")
    lists = materialize(lists, "lists")
    answers = repeated.join(lists.withColumnRenamed("id", "first"), "first")
    few = answers.where(F.col("copies") <= HOT_ROWS)
    later, hot = rows, answers.where(F.col("copies") > HOT_ROWS)
    parts = []
    if not repeated.where(F.col("copies") > HOT_ROWS).isEmpty():
        # At most (rows / HOT_ROWS) vectors are that frequent; their rows stay in place.
        hot = F.broadcast(hot)
        later = rows.join(hot.select("cluster", "vector"), ["cluster", "vector"], "left_anti")
        parts.append(rows.join(hot, ["cluster", "vector"]))
    parts.append(later.join(few, ["cluster", "vector"]))
    copies = [p.where(F.col("id") != F.col("first")).select("id", "found") for p in parts]
    return reduce(DataFrame.unionByName, [lists.select("id", "found"), *copies])


def _distinct_items(rows: DataFrame, row_id: str, k: int, block_rows: int, pivots_per_cluster: int) -> DataFrame:
    """Ask for longer lists until every row has ``k`` other items or has seen its whole cluster."""
    sizes = rows.select("cluster", "item").distinct().groupBy("cluster").agg(F.count("*").alias("items"))
    points = rows.groupBy("cluster", "item", "vector").agg(F.min("id").alias("id"))  # equal rows of an item count once
    open_rows, done, n = rows, None, 4 * (k + 1)
    while True:
        every = _for_every_row(rows, _lists(points, n, block_rows, pivots_per_cluster))
        every = every.join(open_rows.select("id", "item"), "id")
        foreign = every.select("id", F.inline(F.filter("found", lambda s: s["item"] != F.col("item"))).alias("dist", "nn", "nn_item"))
        nearest = foreign.groupBy("id", "nn_item").agg(F.min(F.struct("dist", "nn")).alias("s"))
        order = Window.partitionBy("id").orderBy("s")
        top = nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        top = materialize(top.select("id", "rank", F.col("nn_item").alias("nn_id"), F.col("s.dist").alias("nn_dist")), "items")
        counts = top.groupBy("id").agg(F.count("*").alias("have"))
        wanting = lookup_join(open_rows, sizes, ["cluster"]).join(counts, "id", "left")
        short = F.coalesce("have", F.lit(0)) < F.least(F.lit(k), F.col("items") - 1)
        missing = materialize(wanting.where(short).select(*rows.columns), "open")
        answered = top.join(missing.select("id"), "id", "left_anti")
        done = answered if done is None else done.unionByName(answered)
        if missing.isEmpty():
            return done.select(F.col("id").alias(row_id), "rank", "nn_id", "nn_dist")
        open_rows, n = missing, n * 4


def widen(df: DataFrame, neighbors: DataFrame, row_id: str, k: int = 3) -> DataFrame:
    """nn1_id, nn1_dist, ... beside the rows; NULL where the cluster is too small."""
    columns = []
    for i in range(1, k + 1):
        here = F.col("rank") == i
        columns += [F.max(F.when(here, F.col("nn_id"))).alias(f"nn{i}_id"), F.max(F.when(here, F.col("nn_dist"))).alias(f"nn{i}_dist")]
    wide = neighbors.groupBy(row_id).agg(*columns)
    return df.join(wide, row_id, "left")
