"""Keyed deduplication, incremental loads, joins and set operations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import hot_key_join, lookup_join


def drop_blank_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys all hold something but whitespace, keys trimmed."""
    trimmed = df.withColumns({k: F.trim(F.col(k).cast("string")) for k in keys})
    for k in keys:
        trimmed = trimmed.where(F.col(k) != "")
    return trimmed


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    The rank filter is applied before the shuffle as well (window group limit), so
    at most ``n`` rows per key and input partition move, however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


def unseen(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(*keys).distinct(), keys, "left_anti")


def new_rows(incoming: DataFrame, stored: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First incoming row of every unseen key; copies are cut down before the anti join."""
    return unseen(first_per_key(incoming, keys, order), stored, keys)


def merge_new(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Stored rows followed by the unseen ones."""
    return stored.unionByName(new_rows(incoming, stored, keys, order), allowMissingColumns=True)


def distinct_items(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First appearance of each item in its slice, with the running position kept by ``order``."""
    return first_per_key(df, keys, order)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def rows_per_key(df: DataFrame, keys: list[str], name: str = "new_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, keys: list[str], name: str = "n_keys") -> DataFrame:
    """Number of distinct keys; the distinct is combined map-side."""
    return df.select(*keys).distinct().agg(F.count("*").alias(name))


def with_provenance(df: DataFrame, values: dict[str, Column], payload_wins: bool) -> DataFrame:
    """Add context columns; on a name clash either the payload or the context is kept.

    Times are passed in, so that a rerun gives the same rows.
    """
    return df.withColumns({k: v for k, v in values.items() if not (payload_wins and k in df.columns)})


def worklist(stores: DataFrame, categories: DataFrame) -> DataFrame:
    """Every store with every category.

    The product is wanted in full.  Each side is dealt into as many parts as give four
    pairs of parts for each shuffle partition, and goes to every part of the other side:
    an equi-join on (store part, category part) whose keys grow with the partitions, with
    no nested loop and no broadcast of unknown size.
    """
    parts = math.ceil(math.sqrt(4 * int(stores.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    part = lambda df: F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = stores.withColumn("__a", part(stores)).withColumn("__b", every)
    right = categories.withColumn("__b", part(categories)).withColumn("__a", every)
    return left.join(right, ["__a", "__b"]).drop("__a", "__b")


def page_plan(work: DataFrame, step: int, last: int) -> DataFrame:
    """One row per page: a finite offset sequence for each work item."""
    return work.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(last), F.lit(step))))


def attach_label(df: DataFrame, labels: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Label of each group onto its rows, rows without one kept."""
    return lookup_join(df, labels, [key], "left")


def align(left: DataFrame, right: DataFrame, row_id: list[str]) -> DataFrame:
    """Columns of two frames side by side, matched on an explicit row id."""
    return left.join(right, row_id, "left")


def align_skewed(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """As ``align``, for a key that repeats on the left and may be hot."""
    return hot_key_join(left, right, on, how)


def union_existing_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True).distinct()
