"""Summaries, ranks, limits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .quantiles import group_median, group_mode, group_quantile
from .skew import lookup_join


def cluster_summary(
    df: DataFrame,
    cluster: str = "cluster_id",
    label: str = "cluster_label",
    price: str = "data-product-price-reg_retail_max",
    risk: str = "tariff_risk",
    outlier: str = "cluster_outlier",
) -> DataFrame:
    """One row per cluster: size, label, median price, share of risky rows and of outliers."""
    share = lambda c: F.avg(F.when(F.col(c) == 1, 1.0).otherwise(0.0))
    sizes = df.groupBy(cluster).agg(
        F.count("*").alias("n"),
        F.min(label).alias("label"),
        share(risk).alias("imported_share"),
        share(outlier).alias("outlier_rate"),
    )
    medians = group_median(df, [cluster], price, "median_price")
    joined = lookup_join(sizes, medians, [cluster], "left")
    return joined.select(cluster, "n", "label", "median_price", "imported_share", "outlier_rate").orderBy(
        F.col("n").desc(), F.col("median_price").asc_nulls_last(), cluster
    )


def group_labels(df: DataFrame, cluster: str = "cluster_id", name_columns=("data-product-category-name", "category_path")) -> DataFrame:
    """Label of each cluster: the mode of the first name column that exists."""
    source = next((c for c in name_columns if c in df.columns), None)
    named = df.select(cluster, (F.col(source) if source else F.lit(None).cast("string")).alias("__name"))
    return group_mode(named, [cluster], "__name", "cluster_label")


def outlier_flag(df: DataFrame, cluster: str = "cluster_id", dist: str = "cluster_dist", prob: float = 0.95, approximate: bool = False) -> DataFrame:
    """1 where the distance exceeds the percentile of its cluster; the cut-offs are joined back."""
    cuts = group_quantile(df, [cluster], dist, prob, "__cut", approximate)
    flagged = lookup_join(df, cuts, [cluster], "left")
    flag = F.coalesce((F.col(dist) > F.col("__cut")).cast("int"), F.lit(0))
    return flagged.withColumn("cluster_outlier", flag).drop("__cut")


def rank_rows(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position in a total order, without gathering the rows in one task.

    Rows are range-partitioned and written; the small table of partition sizes
    gives the offset that each partition's own numbering starts from.
    """
    ordered = materialize(df.sort(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    within = Window.partitionBy("__part").orderBy(*order)
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    numbered = ordered.withColumn("__n", F.row_number().over(within))
    return (
        lookup_join(numbered, starts, ["__part"])
        .withColumn(name, F.col("__n") + F.col("__start"))
        .drop("__part", "__n", "__start")
    )


def arg_max(df: DataFrame, keys: list[str], pick: str, score: str, name: str = "best") -> DataFrame:
    """``pick`` of the row with the highest score, the smallest on ties."""
    return df.groupBy(*keys).agg(F.min_by(pick, F.struct(-F.col(score), F.col(pick))).alias(name))


def head(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the same for the same seed: the smallest digests of the key.

    The cut is found by counting digest prefixes; only the rows that share the
    prefix at the cut are ordered.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    marked = df.withColumns({"__digest": digest, "__key": key, "__prefix": F.substring(digest, 1, 4)})
    upto = Window.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most 65,536 rows
    sizes = marked.groupBy("__prefix").agg(F.count("*").alias("__n")).withColumn("__upto", F.sum("__n").over(upto))
    cut = sizes.where(F.col("__upto") > n).orderBy("__prefix").first()
    if cut is None:
        return df
    below = marked.where(F.col("__prefix") < cut["__prefix"])
    order = Window.partitionBy("__prefix").orderBy("__digest", "__key")
    edge = marked.where(F.col("__prefix") == cut["__prefix"]).withColumn("__r", F.row_number().over(order))
    edge = edge.where(F.col("__r") <= n - (cut["__upto"] - cut["__n"])).drop("__r")
    return below.unionByName(edge).drop("__digest", "__key", "__prefix")


def top_counts(df: DataFrame, key: str, n: int = 25, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name)).orderBy(F.col(name).desc(), key).limit(n)


def min_max_scale(df: DataFrame, column: str, name: str) -> DataFrame:
    """Column scaled to 0..1; zeros when its range is below 1e-9 or not finite.

    The range is a scalar subquery, so no row moves.
    """
    x = F.col(column)
    known = df.where(x.isNotNull() & ~F.isnan(x))
    low = known.agg(F.min(column)).scalar()
    high = known.agg(F.max(column)).scalar()
    span = high - low
    flat = span.isNull() | F.isnan(span) | (F.abs(span) == float("inf")) | (span < 1e-9)
    return df.withColumn(name, F.when(flat, F.lit(0.0)).otherwise((x - low) / (span + F.lit(1e-9))))
