"""Collection jobs: landed payloads to keyed store and product documents, and their flat exports.

Fetching is not part of this package; the jobs start from folders of JSON lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import relate
from ..operators.flatten import add_fields, first_filled, key_values, replace_fields
from ..session import materialize, ship_package
from ..sources.files import load_categories, read_dimension, read_jsonl
from ..sources.sinks import append_documents, export_flat
from ..streaming.ingest import ITEM_PATHS, STORE_PATHS

NEARBY_STORES = "$.data.nearby_stores.stores"


@dataclass(frozen=True)
class CollectionPaths:
    stores: str
    products: str
    store_table: str
    product_table: str


def discovered_stores(payloads: DataFrame, zip_code: str = "zip_code", discovered_at: str = "discovered_at", line: str = "line") -> DataFrame:
    """(store_id, _discovery_zip, _discovered_at, store): every store in every nearby payload.

    ``store`` is the store's own JSON text.
    """
    parsed = payloads.select(zip_code, discovered_at, F.try_parse_json(line).alias("__v"))
    stores = F.try_variant_get("__v", NEARBY_STORES, "array<variant>")
    rows = parsed.select(zip_code, discovered_at, F.explode_outer(stores).alias("s")).where(F.col("s").isNotNull())
    found = rows.select(
        first_filled(F.col("s"), [("store_id",)]).alias("store_id"),
        F.col(zip_code).alias("_discovery_zip"),
        F.col(discovered_at).alias("_discovered_at"),
        F.to_json("s").alias("store"),
    )
    return relate.drop_blank_keys(found, ["store_id", "_discovery_zip"])


def stored_store_ids(spark: SparkSession, path: str) -> DataFrame:
    docs = read_jsonl(spark, path)
    ids = docs.select(first_filled(F.col("doc"), [("store_id",), ("store", "store_id")]).alias("store_id"))
    return ids.where("store_id <> ''").distinct()


def collect_stores(spark: SparkSession, payloads: DataFrame, paths: CollectionPaths, dedupe: bool = True) -> DataFrame:
    """Append the stores not stored yet, each with where and when it was first found; (zip, new_count) is returned.

    Context fields replace fields of the same name in the store document.
    """
    found = discovered_stores(payloads)
    if dedupe:
        order = [F.col("_discovered_at"), F.col("_discovery_zip"), F.col("store")]
        found = relate.new_rows(found, stored_store_ids(spark, paths.stores), ["store_id"], order)
    context = {c: F.col(c) for c in ("_discovery_zip", "_discovered_at")}
    new = materialize(found.withColumn("doc", replace_fields(F.col("store"), context)), "stores")
    append_documents(new, "doc", paths.stores)
    return relate.rows_per_key(new, ["_discovery_zip"], "new_count")


def stored_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (store_id, tcin) of the stored product documents."""
    docs = read_jsonl(spark, path)
    pairs = docs.select(first_filled(F.col("doc"), STORE_PATHS).alias("store_id"), first_filled(F.col("doc"), ITEM_PATHS).alias("tcin"))
    return pairs.where("store_id <> '' AND tcin <> ''").distinct()


def listed_items(pages: DataFrame, max_per_category: int | None = None, line: str = "line") -> DataFrame:
    """Distinct (store_id, category_id, tcin) in listing payloads, at most ``max_per_category`` each by item id."""
    items = key_values(pages, line, "tcin", ["store_id", "category_id"], "tcin")
    if max_per_category:
        items = relate.first_per_key(items, ["store_id", "category_id"], [F.col("tcin")], max_per_category)
    return items


def open_pages(stores: DataFrame, categories: DataFrame, step: int, last: int) -> DataFrame:
    """Pages to ask for: every store, every category with an id, every offset from 0 to ``last`` in steps of a page."""
    wanted = relate.drop_blank_keys(categories.select(F.col("data_id").alias("category_id"), "url_path"), ["category_id"])
    return relate.page_plan(relate.worklist(stores.select("store_id"), wanted.distinct()), step, last)


def open_items(items: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Distinct (store_id, tcin) that are listed but not stored."""
    pairs = items.select("store_id", "tcin").distinct()
    return relate.unseen(pairs, stored_pairs(spark, path), ["store_id", "tcin"])


def collect_products(spark: SparkSession, payloads: DataFrame, paths: CollectionPaths) -> DataFrame:
    """Append product payloads (store_id, tcin, fetched_at, line) whose pair is new; (store_id, new_count) is returned.

    Fields of the payload win over the context fields.
    """
    keyed = relate.drop_blank_keys(payloads, ["store_id", "tcin"]).where(F.try_parse_json("line").isNotNull())
    new = relate.new_rows(keyed, stored_pairs(spark, paths.products), ["store_id", "tcin"], [F.col("fetched_at"), F.col("line")])
    context = {"_store_id": F.col("store_id"), "_tcin": F.col("tcin"), "_fetched_at": F.col("fetched_at")}
    new = materialize(new.withColumn("doc", add_fields(F.col("line"), context)), "products")
    append_documents(new, "doc", paths.products)
    return relate.rows_per_key(new, ["store_id"], "new_count")


def export_tables(spark: SparkSession, paths: CollectionPaths, which=("stores", "products"), fmt: str = "csv") -> None:
    """Flatten what is stored, without collecting anything new."""
    ship_package(spark)
    if "stores" in which:
        export_flat(spark, paths.stores, paths.store_table, fmt)
    if "products" in which:
        export_flat(spark, paths.products, paths.product_table, fmt)


def load_zip_codes(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """ZIP dimension; ``limit`` keeps the first codes, for trial runs."""
    zips = read_dimension(spark, path, key="ZIP Code")
    return zips.orderBy("ZIP Code").limit(limit) if limit else zips


__all__ = [
    "CollectionPaths", "collect_products", "collect_stores", "export_tables", "listed_items", "load_categories", "load_zip_codes",
    "open_items", "open_pages", "stored_pairs", "stored_store_ids",
]
