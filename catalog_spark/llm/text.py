"""Texts of Arrow batches as flat byte arrays, and bounded samples of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 20


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end) of the UTF-8 texts of a column; a null counts as empty."""
    column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start, end = offsets[:-1], offsets[1:]
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return data, start, np.where(valid, end, start)


def chunks(start: np.ndarray, end: np.ndarray, size: int) -> list[slice]:
    """Runs of rows with about ``size`` bytes each; a longer text is a run of its own."""
    total = np.r_[0, np.cumsum(end - start)]
    cuts = [0]
    while cuts[-1] < len(start):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(total, total[cuts[-1]] + size, "right")) - 1))
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def bounded_sample(rows: DataFrame, group: str, bound: int, key: Column, most_groups: int = 10_000) -> DataFrame:
    """About ``bound`` rows of each group, chosen by a hash of ``key``; a smaller group comes whole."""
    sizes = rows.groupBy(group).count().where(F.col(group).isNotNull() & (F.col("count") > bound)).limit(most_groups + 1).collect()
    if len(sizes) > most_groups:
        raise ValueError(f"over {most_groups} groups in {group}")
    share = F.lit(SLOTS)
    if sizes:
        shares = F.create_map(*[x for r in sizes for x in (F.lit(r[group]), F.lit(-(-SLOTS * bound // r["count"])))])
        share = F.coalesce(shares[F.col(group)], share)
    return rows.where(F.pmod(F.xxhash64(key, F.lit(bound)), F.lit(SLOTS)) < share)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(17).integers(1, 1 << 62, (4, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Kinds of bytes: white space, symbols, and letters or digits with everything beyond ASCII.
BLANK, SYMBOL, LETTER = 0, 1, 2
_KIND = np.full(256, SYMBOL, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = BLANK
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _BACK)):
            _powers[k] = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 20), base)])
    return _powers[0], _powers[1]


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, symbols: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, from, to) of the words of texts that lie in order in ``data``.

    Words are stretches without white space; with ``symbols``, stretches of one kind of byte, so "a%%%" is two.
    """
    low, high = (int(start[0]), int(end[-1])) if len(start) else (0, 0)
    kind = _KIND[data[low:high]]
    if not symbols:
        kind = np.minimum(kind, SYMBOL)
    inside = np.zeros(high - low + 1, np.int8)
    np.add.at(inside, start[end > start] - low, 1)
    edge = np.ones(high - low, bool)
    edge[1:] = (kind[1:] != kind[:-1]) | (inside[1:-1] > 0)
    at = np.flatnonzero(edge)
    to = np.r_[at[1:], high - low]
    real = kind[at] != BLANK
    at, to = at[real] + low, to[real] + low
    full = np.flatnonzero(end > start)
    owner = full[np.searchsorted(start[full], at, "right") - 1] if len(full) else np.zeros(0, np.int64)
    return owner, at, to


def hashed(data: np.ndarray, at: np.ndarray, to: np.ndarray, kind: int = 0, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each stretch of ``data``; equal bytes have equal hashes. Another ``kind`` (0 to 3) is another hash.

    With ``fold``, A-Z count as in lower case.  Only the bytes from the first to the last stretch are read.
    """
    if not len(at):
        return np.zeros(0, np.uint64)
    low, high = int(at.min()), int(to.max())
    power, back = _grown(high - low)
    values = _BYTE[kind][_LOWER] if fold else _BYTE[kind]
    sums = np.r_[np.uint64(0), np.cumsum(values[data[low:high]] * power[: high - low])]
    h = (sums[to - low] - sums[at - low]) * back[at - low]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))
