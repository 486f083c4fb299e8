"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

# A lookup of at most this many narrow rows may be sent to every executor.
BROADCAST_ROWS = 200_000
# A key with more rows than this is treated as hot.
HOT_ROWS = 1_000_000


def same_keys(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    """Null-safe equality on all key columns."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in on])


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"__k_{c}") if c in on else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__k_{c}"]) for c in on])
    return left.join(renamed, condition, how).drop(*[f"__k_{c}" for c in on])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    written: bool = False,
) -> DataFrame:
    """Join each fact to its row of ``lookup`` (unique per key, keys matched null-safely).

    The lookup is written once (unless it is ``written`` already) and counted.  Up to ``max_rows`` rows it is
    broadcast, so the facts do not move at all.  A larger one is shuffled, with the
    hot keys of the facts split off first (see ``hot_key_join``).
    """
    if not written:
        lookup = materialize(lookup, "lookup")
    if lookup.count() <= max_rows:
        return _null_safe_join(facts, F.broadcast(lookup), on, how)
    return hot_key_join(facts, lookup, on, how, hot_rows)


def hot_key_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffle join in which facts of hot keys stay where they are.

    At most (rows / hot_rows) keys can be hot, so the hot part of the lookup is
    small however large the facts are; only the remaining keys are shuffled.
    """
    hot = materialize(facts.groupBy(*on).count().where(F.col("count") > hot_rows).select(*on), "hot")
    if hot.isEmpty():
        return _null_safe_join(facts, lookup, on, how)
    hot = F.broadcast(hot)
    hot_lookup = F.broadcast(lookup.join(hot, same_keys(lookup, hot, on), "left_semi"))
    hot_part = _null_safe_join(facts.join(hot, same_keys(facts, hot, on), "left_semi"), hot_lookup, on, how)
    cold_part = _null_safe_join(facts.join(hot, same_keys(facts, hot, on), "left_anti"), lookup, on, how)
    return hot_part.unionByName(cold_part)
