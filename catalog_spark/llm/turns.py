"""Trie of the common beginnings of conversations, by ROLLUP over positional columns of turn ids.

1. Rows.  The turns of a conversation stand in ``WIDTH`` columns side by side, one row a conversation; a longer one
   continues in further rows (blocks).  A block is keyed by the node that the blocks before it lead to, a digest of all
   turns so far, so that every block of every conversation is aggregated in the same pass.
2. Nodes.  ``GROUP BY block, prior, ROLLUP (t0, t1, ...)`` counts all beginnings at once; GROUPING_ID tells how many of
   the columns a group holds, and a group whose last column is null is no beginning.
3. Subtrees.  What the nodes of later blocks add up to is carried to the node that they hang from, in as many steps as
   the number of blocks has binary digits.  A second ROLLUP, over the nodes, then gives each node the sums below it.
4. Ends.  The ids of conversations that end at a node are sorted by range, packed into pieces of text, and hashed in
   order piece by piece; no list of them is held.

Groups combine before any shuffle, so a beginning that a third of all conversations share is one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.skew import lookup_join
from ..session import materialize

WIDTH = 8
GROUP = 5  # conversations of one group start like the first of it
HEADS = 9  # with 0 to 8 turns of it
PIECE = 1 << 16  # characters of ids in a row
ROOT = b""


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, bytes): the turns of each conversation in order, a digest of role and text, and the length of the text.

    Turns are in order of ``turn``, null first, then of role and of the digest; null roles and texts are empty.  Rows
    without conv_id are no conversation and are left out; repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.sha2(text.cast("binary"), 256), role).cast("binary"), 256))
    rows = conversations.where(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "key")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "key", "bytes")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes, turns) of the conversations as they stand: (conv_id, total) and (conv_id, total, place, key, bytes)."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    return sizes, turns.join(sizes, "conv_id").select("conv_id", "total", F.col("pos").alias("place"), "key", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes, turns) as ``as_they_are``, each conversation with a new head.

    Conversation c starts with the first h turns of conversation c - c % 5, all if there are fewer and none if it does not
    exist, and goes on with its own turns after its first h; h is the crc32 of c in digits, modulo 9.
    """
    count = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    ids = count.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), h)
    base = count.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    ids = ids.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    ids = ids.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    ids = materialize(ids, "heads")
    first = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base")  # at most 8 turns for at most 9 conversations
    heads = ids.join(first, "base").where(F.col("pos") <= F.col("h")).select("conv_id", "total", F.col("pos").alias("place"), "key", "bytes")
    own = turns.join(ids, "conv_id").where(F.col("pos") > F.col("h"))
    own = own.select("conv_id", "total", (F.col("pos") - F.col("h") + F.col("head")).alias("place"), "key", "bytes")
    return ids.select("conv_id", "total"), heads.unionByName(own)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key of the node before each block: the digest of the key before it and the turns in between.

    Rows (conv_id, block, keys) come sorted; only the last row is remembered.
    """
    conv, prior, keys = None, ROOT, b""
    for batch in batches:
        out = []
        for c, k in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            prior = hashlib.sha256(prior + keys).digest() if c == conv else ROOT
            conv, keys = c, k
            out.append(prior)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["conv_id", "block", "prior"])


def blocks(sizes: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, total, block, prior, t0, t1, ...): the turns in columns; a conversation without turns has one empty row.

    A column is (key, bytes) of a turn, null after the last one.
    """
    turn = F.struct("key", "bytes")
    place = F.col("place") - 1
    wide = turns.groupBy("conv_id", F.floor(place / width).alias("block")).agg(
        F.max("total").alias("total"), *[F.max(F.when(place % width == i, turn)).alias(f"t{i}") for i in range(width)]
    )
    empty = sizes.where(F.col("total") == 0).select("conv_id", F.lit(0).cast("long").alias("block"), "total", *[F.lit(None).cast(wide.schema[f"t{i}"].dataType).alias(f"t{i}") for i in range(width)])
    wide = materialize(wide.unionByName(empty), "blocks")
    long = wide.where(F.col("total") > width).select("conv_id", "block", F.concat(*_keys(width)).alias("keys"))
    prior = long.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chained, "conv_id long, block long, prior binary")
    chained = wide.where(F.col("total") > width).join(prior, ["conv_id", "block"])
    return chained.unionByName(wide.where(F.col("total") <= width).withColumn("prior", F.lit(ROOT)))


def _keys(width: int) -> list[Column]:
    return [F.coalesce(F.col(f"t{i}.key"), F.lit(b"")) for i in range(width)]


def _node(level: Column, width: int) -> Column:
    """Digest of the node that the first ``level`` columns after ``prior`` lead to."""
    part = [F.when(F.lit(i) < level, k).otherwise(F.lit(b"")) for i, k in enumerate(_keys(width))]
    return F.when(level == 0, F.col("prior")).otherwise(F.unhex(F.sha2(F.concat("prior", *part), 256)))


def _rollup(spark: SparkSession, rows: DataFrame, aggregates: list[str], width: int) -> DataFrame:
    """The aggregates of every beginning in every block, with its ``level`` in the block and the digests of node and parent."""
    names = ", ".join(f"t{i}" for i in range(width))
    found = spark.sql(
        f"""SELECT block, prior, {names}, {width} - bit_count(grouping_id()) AS level, {", ".join(aggregates)}
        FROM {{rows}} GROUP BY block, prior, ROLLUP ({names})""",
        rows=rows,
    )
    last = F.get(F.array(*[F.col(f"t{i}") for i in range(width)]), F.col("level") - 1)
    found = found.withColumn("last", last).where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.col("last").isNotNull()))
    level = F.col("level")
    parent = F.when(level > 0, _node(F.greatest(level - 1, F.lit(0)), width))
    return found.withColumns({"node": _node(level, width), "parent": parent, "last_bytes": F.coalesce("last.bytes", F.lit(0))}).drop("last")


def _carried(nodes: DataFrame, width: int) -> DataFrame:
    """(node, children, leaves, saved) that the later blocks put below the last nodes of a block.

    Blocks form a tree.  Each starts with the sums of its own nodes and points at the block before it; with every step a
    block takes in the blocks that point at it and points twice as far, so the steps are the logarithm of the blocks.
    """
    later = nodes.where(F.col("block") > 0)
    own = later.groupBy(F.col("prior").alias("node")).agg(
        F.count_if(F.col("level") == 1).alias("children"), F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")
    )
    up = nodes.where(F.col("level") == width).select("node", F.when(F.col("block") > 0, F.col("prior")).alias("up"))
    step = materialize(own.join(up, "node"), "carried")
    while not step.where(F.col("up").isNotNull()).isEmpty():
        more = step.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jump = step.select(F.col("node").alias("up"), F.col("up").alias("far"))
        step = lookup_join(step.join(more, "node", "left"), jump, ["up"], "left")
        added = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        step = materialize(step.select("node", "children", added("leaves"), added("saved"), F.col("far").alias("up")), "carried")
    return step.drop("up")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as pieces of text: (node, first id, ids joined by commas)."""
    node, first, parts, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(parts)])], ["node", "first", "ids"])

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if parts and (n != node or size > PIECE):
                yield piece()
                parts, size = [], 0
            if not parts:
                node, first = n, c
            parts.append(str(c))
            size += len(parts[-1]) + 1
    if parts:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one digest a node."""
    node, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if n == node:
                state.update(b",")
            else:
                if state:
                    nodes.append(node)
                    digests.append(state.hexdigest())
                node, state = n, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def _ends(rows: DataFrame, width: int) -> DataFrame:
    """(node, ends_sha256) of the nodes where a conversation ends."""
    last = rows.where(F.col("block") == F.floor(F.greatest(F.col("total") - 1, F.lit(0)) / width))
    ends = last.select(_node(F.col("total") - F.col("block") * width, width).alias("node"), "conv_id")
    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_packed, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, ends_sha256 string")


def trie(sizes: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row a node of the trie of conversations, given as (conv_id, total) and (conv_id, total, place, key, bytes).

    A node is a distinct sequence of first turns, the root the empty one; its members are the conversations that start
    with it, and ``conv_id`` is the smallest of them.  ``n_children`` counts the nodes one turn longer, ``n_leaves`` the
    nodes without children in its subtree, ``saved_tokens`` adds (members - 1) times the bytes of the last text over the
    subtree, ``ends_sha256`` is the digest of the ids that end here, ascending and joined by commas.  Conversations
    without turns belong to the root; without conversations there is no node.
    """
    spark = sizes.sparkSession
    rows = materialize(blocks(sizes, turns, width), "rows")
    nodes = _rollup(spark, rows, ["min(conv_id) AS conv_id", "count(*) AS n_convs", "max(total) AS most"], width)
    depth = F.col("block") * width + F.col("level")
    nodes = nodes.withColumns({"depth": depth, "leaf": (F.col("most") == depth).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("last_bytes")})
    nodes = materialize(nodes, "nodes")
    below = _carried(nodes, width)
    hung = nodes.join(below.select("node", F.col("children").alias("below_children"), F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved")), "node", "left")
    hung = hung.withColumnRenamed("level", "own_level").drop("node", "parent", "last_bytes", "most")
    counts = ", ".join(f"count_if(own_level = {i + 1})" for i in range(width))
    sums = [
        "min(conv_id) AS conv_id", "min(depth) AS depth", "max(n_convs) AS n_convs", f"array({counts}, sum(coalesce(below_children, 0))) AS counts",
        "sum(leaf + coalesce(below_leaves, 0)) AS n_leaves", "sum(saved + coalesce(below_saved, 0)) AS saved_tokens",
    ]
    found = _rollup(spark, hung, sums, width).withColumn("n_children", F.get("counts", F.col("level")))
    found = found.select("node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
    found = lookup_join(found, nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), ["parent"], "left")
    found = found.join(_ends(rows, width), "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, new_heads: bool = True, width: int = WIDTH) -> DataFrame:
    """Trie of (conv_id, turn, role, text), the conversations as they are or rebuilt with shared heads (see ``rebuilt``)."""
    turns = materialize(turn_ids(conversations), "turns")
    return trie(*(rebuilt(turns) if new_heads else as_they_are(turns)), width)
