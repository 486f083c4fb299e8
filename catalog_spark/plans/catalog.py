"""Reports over the cleaned product table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import price_band
from ..operators.quantiles import group_median, group_mode
from ..operators.skew import lookup_join


def product_report(df: DataFrame, category: str, price: str, risk: str = "tariff_risk") -> DataFrame:
    """Per category: products, median price, share exposed to import duty, most common price band."""
    rows = df.select(category, price, risk, price_band(F.col(price)).alias("__band"))
    sizes = rows.groupBy(category).agg(F.count("*").alias("n"), F.avg(F.when(F.col(risk) == 1, 1.0).otherwise(0.0)).alias("imported_share"))
    report = lookup_join(sizes, group_median(rows, [category], price, "median_price"), [category], "left")
    report = lookup_join(report, group_mode(rows, [category], "__band", "main_band"), [category], "left")
    return report.select(
        category, "n", F.round("median_price", 6).alias("median_price"), F.round("imported_share", 6).alias("imported_share"), "main_band"
    ).orderBy(F.col("n").desc(), category)
