"""Arithmetic on dense vectors stored as ARRAY<DOUBLE>, and the entries of vectors of either kind."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F


def as_double(c: Column) -> Column:
    return c.cast("array<double>")


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, z: s + z)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def scale(a: Column, weight: float) -> Column:
    return F.transform(a, lambda x: x * F.lit(float(weight)))


def entries(df: DataFrame, vector: str) -> Column:
    """The vector as the fields of the vector type, sparse or dense (no indices); an array counts as dense."""
    if isinstance(df.schema[vector].dataType, VectorUDT):
        return F.unwrap_udt(vector)
    values = F.col(vector).cast("array<double>")
    empty = [F.lit(None).cast("int").alias("size"), F.lit(None).cast("array<int>").alias("indices")]
    return F.when(values.isNotNull(), F.struct(F.lit(1).cast("tinyint").alias("type"), *empty, values.alias("values")))


def nonfinite_entries(df: DataFrame, row_id: str, vector: str = "features") -> DataFrame:
    """(row_id, position, value) of the NaN and infinite entries; stored entries are looked at where they are, none else is listed."""
    bad = lambda x: F.isnan(x) | (F.abs(x) == float("inf"))
    named = lambda i, x: F.struct(i.alias("position"), x.alias("value"))
    rows = df.select(row_id, entries(df, vector).alias("__v")).where(F.exists("__v.values", bad))
    dense = F.transform("__v.values", lambda x, i: named(i, x))
    cells = F.when(F.col("__v.indices").isNull(), dense).otherwise(F.zip_with("__v.indices", "__v.values", named))
    return rows.select(row_id, F.inline(F.filter(cells, lambda c: bad(c["value"]))))
