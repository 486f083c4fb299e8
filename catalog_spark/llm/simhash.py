"""Near-duplicate documents by SimHash fingerprints and a hierarchical index in Gray order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .graph import components

SEED = 42
PIECE_BYTES = 1 << 20  # a text is hashed in pieces of this size, so that its words never lie in memory all at once
FAN_OUT = 16
QUERY_ROWS = 1024
BLOCKS = 5  # a fingerprint is cut into this many blocks of bits
HOT_BUCKET = 20_000  # a bucket with more fingerprints than this is searched by several tasks
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_LANES = np.uint64(0x0101010101010101)


# --- fingerprints -------------------------------------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + PIECE_BYTES) if at + PIECE_BYTES < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()  # bytes: lower() and split() know ASCII only
        at = end


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits; eight bits at a time are added in the bytes of one word."""
    lanes = (hashes[:, None] >> np.arange(8, dtype=np.uint64)) & _LANES
    sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 8, 8).sum(axis=0, dtype=np.int64).T.reshape(64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of a whole text, as an unsigned number; 0 without words."""
    counts, n, held = np.zeros(64, np.int64), 0, []
    for words in _pieces(text or b""):
        held += words
        if len(held) >= shingle:
            tuples = zip(*(held[i:] for i in range(shingle)))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, tuples), repeat(SEED)), np.uint64)
            counts, n = counts + _bit_counts(hashes), n + len(hashes)
            held = held[len(held) - shingle + 1 :]
    if n == 0 and held:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED)
    return int((counts * 2 > n).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))) if n else 0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint of every document as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "bits"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, "doc_id long, bits long")


# --- the index ------------------------------------------------------------------------------------------------------


def gray_rank(bits: Column) -> Column:
    """Place of a 64-bit word in the reflected Gray sequence, as a signed number that sorts like the unsigned one."""
    for step in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, step))
    return bits.bitwiseXOR(F.lit(-(2**63)))


class GrayIndex:
    """Fingerprints of many buckets, sorted by bucket and Gray rank, under levels of nodes.

    A node covers up to FAN_OUT neighbours of the level below, within one bucket.  It holds the bits on which all
    fingerprints below it agree; a child repeats none of its parent's bits, it only adds the ones that become shared
    lower down.  A search adds up differences from the top and drops a node, and with it the whole group, as soon as
    the sum passes the limit.
    """

    def __init__(self, bucket: np.ndarray, bits: np.ndarray):
        self.bits = bits
        every, some, own = bits, bits, bucket
        self.levels = []  # from the leaves up: (first child, past the last child, mask, pattern, last leaf)
        last = np.arange(len(bits))
        self.root = None
        while True:
            new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            place = np.arange(len(own)) - np.repeat(new, np.diff(np.r_[new, len(own)]))
            start = np.flatnonzero(place % FAN_OUT == 0)
            end = np.r_[start[1:], len(own)]
            every, some, last = np.bitwise_and.reduceat(every, start), np.bitwise_or.reduceat(some, start), last[end - 1]
            mask = ~(every ^ some)
            self.levels.append((start, end, mask, every & mask, last))
            own = own[start]
            if len(start) == len(new):
                break
        self.root = np.searchsorted(own, bucket)

    def pairs(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaves (query, other) of one bucket with query < other and at most ``limit`` differing bits."""
        node, q = self.root[queries], queries
        above = np.zeros(len(q), np.uint64)
        d = np.zeros(len(q), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            start, end, mask, pattern, last = self.levels[level]
            d = d + np.bitwise_count((self.bits[q] ^ pattern[node]) & mask[node] & ~above)
            near = (d <= limit) & (last[node] > q)
            q, node, d = q[near], node[near], d[near]
            above, size = mask[node], end[node] - start[node]
            first = np.repeat(start[node] - np.r_[0, np.cumsum(size)[:-1]], size)
            node = first + np.arange(len(first))
            q, d, above = np.repeat(q, size), np.repeat(d, size), np.repeat(above, size)
        d = d + np.bitwise_count((self.bits[q] ^ self.bits[node]) & ~above)
        near = (d <= limit) & (node > q)
        return q[near], node[near]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least members of the groups that the pairs (a, b) make of the groups in ``label``."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def _links(table: pa.Table, limit: int) -> pa.RecordBatch:
    """Edges that join the linked documents of complete buckets, at most one a row."""
    code, bits = table["code"].to_numpy(), table["bits"].to_numpy().view(np.uint64)
    doc, asked = table["doc_id"].to_numpy(), table["asked"].to_numpy(zero_copy_only=False)
    change = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (table["salt"].to_numpy()[1:] != table["salt"].to_numpy()[:-1])])
    size = np.diff(np.r_[change, len(code)])
    many = np.repeat(size > 1, size)
    bucket, bits, doc, asked = np.repeat(np.arange(len(size)), size)[many], bits[many], doc[many], asked[many]
    label = np.arange(len(bits))
    if len(bits):
        index, queries = GrayIndex(bucket, bits), np.flatnonzero(asked)
        for at in range(0, len(queries), QUERY_ROWS):
            label = _merge(label, *index.pairs(queries[at : at + QUERY_ROWS], limit))
    hung = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(doc[hung]), pa.array(doc[label[hung]])], ["a", "b"])


def _search(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                last = np.column_stack([batch["code"].to_numpy(), batch["salt"].to_numpy()])
                same = (last == last[-1]).all(axis=1)
                cut = len(last) - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield _links(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]), limit)
                    held = [batch.slice(cut)]
        if held:
            yield _links(pa.Table.from_batches(held), limit)

    return run


def _codes(bits: Column, limit: int) -> Column:
    """One code for each choice of BLOCKS - limit blocks: fingerprints at most ``limit`` bits apart share one of them."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(BLOCKS)]
    chosen = [sum(masks[i] for i in c) for c in combinations(range(BLOCKS), BLOCKS - limit)]
    signed = [m - (1 << 64) if m >> 63 else m for m in chosen]
    return F.array(*[F.xxhash64(F.lit(i), bits.bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])


def links(reps: DataFrame, limit: int = 3, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Edges (a, b) joining the documents of ``reps`` (doc_id, bits; bits distinct) that are linked.

    Only the edges needed to keep linked documents together are made, not every pair.  Rows meet in buckets of
    equal blocks; a large bucket is searched by several tasks, each with the whole bucket but its own queries.
    """
    if not 0 <= limit < BLOCKS:
        raise ValueError(f"limit must be from 0 to {BLOCKS - 1}")
    coded = reps.select("doc_id", "bits", F.explode(_codes(F.col("bits"), limit)).alias("code"))
    hot = coded.groupBy("code").count().where(F.col("count") > hot_bucket).select("code", F.ceil(F.col("count") / hot_bucket).cast("int").alias("parts"))
    dealt = coded.join(hot, "code", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    dealt = dealt.select("doc_id", "bits", "code", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    dealt = dealt.select("doc_id", "bits", "code", "salt", (F.col("own") == F.col("salt")).alias("asked"), gray_rank(F.col("bits")).alias("rank"))
    dealt = dealt.repartition("code", "salt").sortWithinPartitions("code", "salt", "rank").drop("rank")
    return dealt.mapInArrow(_search(limit), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    Documents whose fingerprints differ in at most ``limit`` bits are linked; ``component_id`` is the smallest
    doc_id reachable.  A text without words, empty or null has fingerprint zero and is linked like any other.
    Rows with a null doc_id get a null component and link with nothing; rows with equal doc_id are one document
    and stay as often as they come (each with its own fingerprint).  An empty table gives an empty result; other
    columns are not looked at.
    """
    made = materialize(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    named = made.where("doc_id is not null")
    reps = materialize(named.groupBy("bits").agg(F.min("doc_id").alias("doc_id")), "representatives")
    # a doc_id that comes with several texts ties their fingerprints together
    several = named.groupBy("doc_id").agg(F.min("bits").alias("x"), F.max("bits").alias("y")).where("x <> y").select("doc_id")
    tied = named.join(several, "doc_id", "left_semi").join(reps.withColumnRenamed("doc_id", "first"), "bits").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    roots = components(links(reps, limit).unionByName(tied), "a", "b")
    classes = reps.join(roots, reps["doc_id"] == roots["node"], "left").select("bits", F.coalesce("root", "doc_id").alias("component_id"))
    return made.join(classes, "bits", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 3) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, and rows without a doc_id."""
    found = near_duplicates(docs, doc_id, text, shingle, limit)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs[doc_id] == kept["__kept"], "left_semi").unionByName(docs.where(F.col(doc_id).isNull()))
