"""Compression of vectors to codes: the index of the nearest codebook entry for each part of a vector.

1. Whole components.  A component x is floor(256 * x); a vector is cut into equal consecutive parts.
2. Distinct parts.  Each round works on the distinct parts of all vectors with the number of their copies, range
   partitioned and sorted by (place, components), so that equal prefixes of components lie together.
3. Trie.  A sorted stretch of parts is a trie over the components.  It is walked depth first: a node holds the vector of
   squared distances to all entries, added up over the components above it, so a shared prefix is worked out once.  A
   subtree of few leaves is finished level by level in one array.  At the leaves the argmin is the entry (the lowest on
   ties) and adds its components, times the copies, to the sums of that entry.
4. Codes.  The finished codebooks go to the vectors: the parts of a batch are sorted into a trie of their own, so the
   vectors do not move.

What is on the driver, and sent to the tasks, is the codebooks: ``entries`` vectors, however many rows there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import lookup_join
from ..session import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAVES = 1 << 13  # a subtree of at most this many leaves is finished in one array
STRETCH = 1 << 16  # sorted parts that make one trie
GREATEST = 1 << 24  # of a whole component: sums of squared differences of some 2,000 of them fit a long


def whole_components(vectors: DataFrame, embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows whose vector has only finite components, with ``w``: the components times ``scale``, rounded down.

    A component beyond ``GREATEST`` after scaling is refused with an error, as squares of such numbers do not fit a long.
    """
    x = F.col(embedding)
    sound = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    number = lambda c: F.floor(c.cast("double") * scale)
    fits = lambda c: F.abs(c.cast("double") * scale) < GREATEST
    checked = F.transform(x, lambda c: F.when(fits(c), number(c)).otherwise(F.raise_error(F.lit(f"a component is beyond {GREATEST} / {scale}")).cast("long")))
    return vectors.where(x.isNotNull() & sound).withColumn("w", checked)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``width``."""
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < size[:, None]] = column.values.to_numpy()[offsets[0] : offsets[-1]]
    return out


def _runs(rows: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Where the children start among sorted leaves: at another parent, or another component."""
    return np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (parent[1:] != parent[:-1])])


def _grow(rows: np.ndarray, depth: int, above: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Distances of the leaves ``rows`` to all entries of ``book``, below one node at ``depth`` with the distances ``above``.

    One step a level: a node adds its own component to the sums of its parent.
    """
    node = np.zeros(len(rows), np.int64)  # of each leaf, at the level reached
    sums = above[None, :]
    for d in range(depth, rows.shape[1]):
        first = _runs(rows[:, d], node)
        sums = sums[node[first]] + (rows[first, d][:, None] - book[:, d]) ** 2
        node = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
    return sums[node]


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) for sorted distinct ``rows``, by a depth-first walk of their trie; ties to the lower entry."""
    entry, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)

    def finish(low: int, high: int, depth: int, above: np.ndarray) -> None:
        far = _grow(rows[low:high], depth, above, book)
        entry[low:high] = far.argmin(axis=1)
        best[low:high] = far[np.arange(high - low), entry[low:high]]

    open_nodes = [(0, len(rows), 0, np.zeros(len(book), np.int64))]
    while open_nodes:
        low, high, depth, above = open_nodes.pop()
        if high - low <= LEAVES or depth == rows.shape[1]:
            finish(low, high, depth, above)
            continue
        first = low + _runs(rows[low:high, depth], np.zeros(high - low, np.int64))
        together: list[list[int]] = []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), high]):
            if b - a > LEAVES:  # a large child is a node of its own
                open_nodes.append((a, b, depth + 1, above + (rows[a, depth] - book[:, depth]) ** 2))
            elif together and together[-1][1] == a and b - together[-1][0] <= LEAVES:  # small ones go with their neighbours
                together[-1][1] = b
            else:
                together.append([a, b])
        for a, b in together:
            finish(a, b, depth, above)
    return entry, best


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct rows, the place of each row among them)."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    sorted_rows = rows[order]
    new = np.r_[True, (sorted_rows[1:] != sorted_rows[:-1]).any(axis=1)]
    inverse = np.empty(len(rows), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return sorted_rows[new], inverse


def _sums(books: np.ndarray):
    """Arrow function over (place, components, copies): of each entry, its copies and the sums of its components."""
    parts, entries, depth = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, depth + 1), np.int64)
        held, n = [], 0

        def take() -> None:
            place = np.concatenate([b.column(0).to_numpy() for b in held])
            copies = np.concatenate([b.column(2).to_numpy() for b in held])
            rows = np.concatenate([_matrix(b.column(1), depth) for b in held])
            for p in np.unique(place):
                own = np.flatnonzero(place == p)
                own = own[np.lexsort(rows[own].T[::-1])]
                entry, _ = nearest(rows[own], books[p])
                np.add.at(total[p], entry, np.c_[copies[own], rows[own] * copies[own][:, None]])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= STRETCH:
                take()
                held, n = [], 0
        if held:
            take()
        place, entry = np.nonzero(total[:, :, 0])
        if len(place):
            sums = pa.ListArray.from_arrays(np.arange(len(place) + 1, dtype=np.int32) * (depth + 1), total[place, entry].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(entry.astype(np.int32)), sums], ["place", "entry", "sums"])

    return run


def _coded(books: np.ndarray):
    """Arrow function adding (code, error) to rows whose last column is ``w``."""
    parts, entries, depth = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            codes, errors = [None] * n, np.zeros(n, np.int64)
            if entries:
                rows = _matrix(batch.column("w"), parts * depth).reshape(n, parts, depth)
                found = np.zeros((n, parts), np.uint8)
                for p in range(parts):
                    leaves, inverse = _distinct(rows[:, p])
                    entry, best = nearest(leaves, books[p])
                    found[:, p] = entry[inverse]
                    errors += best[inverse]
                codes = [x.tobytes().hex() for x in found]
            error = pa.array(errors, mask=None if entries else np.ones(n, bool))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes, pa.string()), error], [*batch.schema.names[:-1], "code", "error"])

    return run


def _smallest(entries: int):
    """Arrow function over (vec_id, w): the rows of a task's smallest ids, each id once with its smallest vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, list[int]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            low = np.unique(np.r_[ids, np.fromiter(least, np.int64)])[:entries]
            for i in np.flatnonzero(np.isin(ids, low)).tolist():
                w = batch.column(1)[i].as_py()
                least[int(ids[i])] = min(w, least.get(int(ids[i]), w))
            least = {i: w for i, w in least.items() if i in set(low.tolist())}
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int64()), pa.array(list(least.values()), pa.list_(pa.int32()))], ["vec_id", "w"])

    return run


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts, entries, components): the vectors of the smallest ids, cut into parts; fewer ids give fewer entries.

    Vectors are filled up with zeros to the longest one, and that to a multiple of ``parts``.
    """
    width = rows.agg(F.max(F.size("w"))).first()[0] or 0
    depth = -(-width // parts)
    named = rows.where(F.col("vec_id").isNotNull()).select("vec_id", "w")
    found = named.mapInArrow(_smallest(entries), "vec_id long, w array<int>")  # at most ``entries`` rows a task
    least = found.groupBy("vec_id").agg(F.min("w").alias("w")).orderBy("vec_id").limit(entries).collect()
    books = np.zeros((len(least), parts * depth), np.int64)
    for i, row in enumerate(least):
        books[i, : len(row["w"])] = row["w"]
    return np.ascontiguousarray(books.reshape(len(least), parts, depth).transpose(1, 0, 2))


def distinct_parts(rows: DataFrame, parts: int, depth: int) -> DataFrame:
    """(place, components, copies): each distinct part once, along the order of the trie."""
    full = F.concat("w", F.array_repeat(F.lit(0), F.lit(parts * depth) - F.size("w")))
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(full, p * depth + 1, F.lit(depth)))
    found = rows.select(F.posexplode(cut).alias("place", "components")).groupBy("place", "components").agg(F.count("*").alias("copies"))
    return found.repartitionByRange("place", "components").sortWithinPartitions("place", "components")


def improved(found: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every used entry at the mean of its parts, rounded down."""
    depth = books.shape[2]
    sums = found.mapInArrow(_sums(books), "place int, entry int, sums array<long>")
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(depth + 1)]
    better = books.copy()
    for row in sums.groupBy("place", "entry").agg(*totals).collect():  # one row an entry
        better[row["place"], row["entry"]] = [int(row[f"s{d + 1}"]) // int(row["s0"]) for d in range(depth)]
    return better


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, components) of ``rows`` (vec_id, w), after ``rounds`` rounds over all distinct parts."""
    if not 0 < entries <= 256:
        raise ValueError("codes have one byte a part: 1 to 256 entries")
    books = first_books(rows, parts, entries)
    if not books.size:
        return books
    found = materialize(distinct_parts(rows, parts, books.shape[2]), "parts")
    for _ in range(rounds):
        books = improved(found, books)
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row of ``vectors`` (vec_id, embedding, label) that is kept.

    Rows whose vector is null or has null or non-finite components are dropped; repeated rows stay repeated, other columns
    are left out.  Rows without vec_id or label are coded like any other: a null id starts no entry, null labels are one
    label.  An id with several vectors starts its entry with the smallest.  Shorter vectors are filled up with zeros;
    with empty vectors only, every error is 0.  Without any vec_id there is no entry, and code and errors are null.
    An empty table gives no rows.
    """
    kept = whole_components(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("w").cast("array<int>").alias("w"))
    rows = materialize(kept, "vectors")
    books = fit(rows, parts, entries, rounds)
    label = kept.schema["label"].dataType.simpleString()
    coded = materialize(rows.mapInArrow(_coded(books), f"vec_id long, label {label}, code string, error long"), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    found = lookup_join(coded, sums, ["label"])
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
