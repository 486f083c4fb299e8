"""Data-quality profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _profile(df: DataFrame, tests: dict[str, Column], row_id: str, examples: int, count_name: str) -> DataFrame:
    """Count, percentage and first example rows for each test that some row meets."""
    names = list(tests)
    wide = df.agg(F.count("*").alias("__rows"), *[F.count_if(tests[c]).alias(f"c{i}") for i, c in enumerate(names)])
    counts = wide.select(
        "__rows",
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias(count_name)) for i, c in enumerate(names)])),
    ).where(F.col(count_name) > 0)
    hits = F.array_compact(F.array(*[F.when(tests[c], F.lit(c)) for c in names]))
    order = Window.partitionBy("column_name").orderBy("__id")
    shown = (
        df.select(F.col(row_id).alias("__id"), F.explode(hits).alias("column_name"))
        .withColumn("__r", F.row_number().over(order))
        .where(F.col("__r") <= examples)
        .groupBy("column_name")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", "__id"))), lambda s: s["__id"].cast("string")), ",").alias("examples"))
    )
    percent = F.round(F.col(count_name) * F.lit(100.0) / F.col("__rows"), 4)
    return counts.join(shown, "column_name").select("column_name", count_name, percent.alias("percent"), "examples")


def null_profile(df: DataFrame, row_id: str, columns: list[str] | None = None, examples: int = 5) -> DataFrame:
    """Missing values (NULL or NaN) per column that has any."""
    tests = {}
    for name, kind in df.dtypes:
        if columns is None or name in columns:
            missing = F.col(name).isNull()
            tests[name] = (missing | F.isnan(name)) if kind in ("double", "float") else missing
    return _profile(df, tests, row_id, examples, "n_null")


def inf_profile(df: DataFrame, row_id: str, columns: list[str] | None = None, examples: int = 5) -> DataFrame:
    """Positive or negative infinities per numeric column that has any."""
    tests = {
        name: F.coalesce(F.abs(F.col(name)) == float("inf"), F.lit(False))
        for name, kind in df.dtypes
        if kind in ("double", "float") and (columns is None or name in columns)
    }
    if not tests:
        return df.sparkSession.createDataFrame([], "column_name string, n_inf bigint, percent double, examples string")
    return _profile(df, tests, row_id, examples, "n_inf")


def nonfinite_features(long: DataFrame, row_id: str = "row_id", feature: str = "feature", value: str = "value", top: int = 25, examples: int = 5) -> DataFrame:
    """Features with the most NaN and infinite entries in a long-form matrix, with example rows."""
    kind = F.when(F.isnan(value), "nan").when(F.abs(F.col(value)) == float("inf"), "inf")
    bad = long.select(row_id, feature, kind.alias("kind")).where(F.col("kind").isNotNull())
    counts = bad.groupBy("kind", feature).agg(F.count("*").alias("n"))
    by_kind = Window.partitionBy("kind").orderBy(F.col("n").desc(), feature)
    ranked = counts.withColumn("rank", F.row_number().over(by_kind)).where(F.col("rank") <= top)
    order = Window.partitionBy("kind").orderBy(row_id, feature)
    shown = (
        bad.withColumn("__r", F.row_number().over(order))
        .where(F.col("__r") <= examples)
        .groupBy("kind")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", row_id))), lambda s: s[row_id].cast("string")), ",").alias("examples"))
    )
    return ranked.join(F.broadcast(shown), "kind")  # two kinds at most
