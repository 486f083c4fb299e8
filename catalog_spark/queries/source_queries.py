"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import iso_second
from ..session import release, spread, work_folder
from ..sources import files, listing, sinks
from ..spec import curated
from . import fixtures as fx
from .registry import query

K_VALUE = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


@query(
    "jsonl_scan_tolerant",
    f"""
    WITH lines AS (SELECT event_id % 10 AS m, {K_VALUE} AS k FROM events)
    SELECT CASE WHEN m IN (0, 3, 4) THEN 'malformed' ELSE 'ok' END AS status,
      CASE WHEN m IN (0, 3, 4) THEN NULL ELSE k END AS k, count(*) AS n
    FROM lines WHERE m <> 1 GROUP BY 1, 2
    """,
)
def jsonl_scan_tolerant(t):
    path = work_folder(t.spark, "lines")
    sinks.append_documents(fx.raw_lines(t), "line", path)
    rows = files.read_jsonl(t.spark, path, keep_malformed=True)
    return rows.groupBy("status", F.variant_get("doc", "$.k", "bigint").alias("k")).agg(F.count("*").alias("n"))


@query(
    "csv_scan_typed",
    f"""
    SELECT tcin, title, category, brand, n_code, current_retail_min, current_retail, round(reg_retail_max, 6) AS reg_retail_max,
      TRY_CAST(trim(reg_retail_text) AS DOUBLE) AS reg_retail_text, CAST(depth AS BIGINT) AS depth, height, width, handling
    FROM ({fx.V1})
    """,
)
def csv_scan_typed(t):
    path = work_folder(t.spark, "csv")
    sinks.write_csv(fx.products(t), path)
    return files.read_csv_typed(t.spark, path).withColumn("reg_retail_max", F.round("reg_retail_max", 6))


ZIPS = """
SELECT CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN '   ' WHEN c_custkey % 10 = 2 THEN concat(' ', c_custkey, ' ')
    ELSE concat('0', c_custkey) END AS zip_code,
  c_mktsegment AS type, c_name AS cities, concat('county ', c_nationkey) AS county,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat(c_custkey % 7, '00, 5') END AS area_codes
FROM {customer}
"""


@query(
    "dim_scan_zip",
    f"""SELECT trim(zip_code) AS zip_code, type, cities, county, coalesce(area_codes, '') AS area_codes
    FROM ({ZIPS.format(customer='customer')}) WHERE trim(zip_code) <> ''""",
)
def dim_scan_zip(t):
    path = work_folder(t.spark, "zips")
    header = dict(zip(["zip_code", "type", "cities", "county", "area_codes"], files.ZIP_HEADER))
    sinks.write_csv(t.sql(ZIPS, customer=t.customer).withColumnsRenamed(header), path)
    back = files.read_dimension(t.spark, path, key="ZIP Code")
    return back.withColumnsRenamed({v: k for k, v in header.items()})


CATEGORIES = """
SELECT DISTINCT brand AS name, 's' AS slug, '/c' AS url_path, 'u' AS full_url,
  CASE WHEN depth % 5 = 0 THEN '' ELSE n_code END AS n_code, CASE WHEN depth % 2 = 0 THEN concat('d', depth) END AS data_id,
  '0' AS number_of_children FROM {products}
"""


@query(
    "category_dim_load",
    f"""SELECT name, n_code, coalesce(data_id, regexp_extract(n_code, '(?i)N-([0-9a-z]+)', 1)) AS data_id
    FROM ({CATEGORIES.format(products='(' + fx.V1 + ')')})""",
)
def category_dim_load(t):
    path = work_folder(t.spark, "categories")
    sinks.write_csv(t.sql(CATEGORIES, products=fx.products(t)), path)
    return files.load_categories(t.spark, path).select("name", "n_code", "data_id")


LISTING_SQL = r"""
WITH items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) AS item,
    generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>'), 1) AS i FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, regexp_extract(item, 'href="([^"]*)"', 1) AS href,
  trim(regexp_replace(replace(replace(regexp_extract(item, '">([^<]*)</a>', 1), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text
FROM items
"""


@query("html_listing_extract", LISTING_SQL)
def html_listing_extract(t):
    return listing.anchor_items(t.pages)


@query("listing_csv_roundtrip", LISTING_SQL.replace("CAST(i - 1 AS INTEGER)", "CAST(i - 1 AS VARCHAR)").replace("SELECT page_id, CAST", "SELECT CAST(page_id AS VARCHAR) AS page_id, CAST"))
def listing_csv_roundtrip(t):
    path = work_folder(t.spark, "listing")
    sinks.write_csv(listing.anchor_items(t.pages), path)
    return files.read_dimension(t.spark, path)


PANELS = """
SELECT c_custkey AS page_id, concat('<html><body><div>x</div><div class="panel panel-default panel-prefixes">',
  CASE WHEN c_custkey % 2 = 0 THEN '<div class="panel-heading"><div class="row"><div class="col-xs-2 prefix-col1"> ZIP Code </div><div class="prefix-col2">Type</div><div class="prefix-col3">Common Cities</div><div class="prefix-col4">County</div><div class="prefix-col5">Area Codes</div></div></div>' ELSE '' END,
  '<div class="list-group"><div class="list-group-item"><div class="row"><div class="col prefix-col1"><a href="/z">', c_custkey, '</a></div><div class="prefix-col2">', c_mktsegment,
  '</div><div class="prefix-col3"><b>', c_name, '</b><br> &amp; co</div>', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '<div class="prefix-col4">A</div>' END,
  '<div class="prefix-col5">1</div></div></div><div class="list-group-item">no row</div><div class="list-group-item"><div class="row"><div class="prefix-col1">second</div></div></div></div></div></body></html>') AS html
FROM {customer}
"""


@query(
    "panel_listing_extract",
    """SELECT c_custkey AS page_id, 0 AS pos, CAST(c_custkey AS VARCHAR) AS zip_code, c_mktsegment AS type, concat(c_name, ' & co') AS cities,
      CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'A' END AS county, '1' AS area_codes FROM customer
    UNION ALL SELECT c_custkey, 1, 'second', '', '', '', '' FROM customer""",
)
def panel_listing_extract(t):
    rows = listing.panel_table(t.sql(PANELS, customer=t.spread("customer", "c_custkey")))
    return rows.toDF("page_id", "pos", "zip_code", "type", "cities", "county", "area_codes")


@query(
    "jsonl_append_roundtrip",
    f"""SELECT store_id, count(*) AS n, CAST(sum(tcin) AS BIGINT) AS tcin_sum, strftime(min(fetched_at), '%Y-%m-%dT%H:%M:%S') AS first_at,
      strftime(max(fetched_at), '%Y-%m-%dT%H:%M:%S') AS last_at FROM ({fx.V2}) GROUP BY store_id""",
)
def jsonl_append_roundtrip(t):
    path = work_folder(t.spark, "append")
    items = spread(fx.store_items(t), "store_id", "tcin").select("store_id", "tcin", iso_second(F.col("fetched_at")).alias("fetched_at"))
    early = F.col("fetched_at") < "1996"
    sinks.append_jsonl(items.where(early), path)
    sinks.append_jsonl(items.where(~early), path)
    doc = files.read_jsonl(t.spark, path).select(
        F.variant_get("doc", "$.store_id", "bigint").alias("store_id"),
        F.variant_get("doc", "$.tcin", "bigint").alias("tcin"),
        F.variant_get("doc", "$.fetched_at", "string").alias("at"),
    )
    return doc.groupBy("store_id").agg(
        F.count("*").alias("n"), F.sum("tcin").alias("tcin_sum"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )


@query(
    "flat_export",
    f"""WITH facts AS ({fx.FACTS})
    SELECT CAST(o_custkey AS VARCHAR) AS "_store_id", o_orderkey AS "data-product-tcin", c_mktsegment AS "data-product-category-name",
      concat('[{{"name":"', r_name, '"}},{{"name":', CASE WHEN o_orderkey % 8 = 0 THEN 'null' ELSE concat('"', n_name, '"') END, '}}]') AS "data-product-category-breadcrumbs",
      CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS "data-product-price-current_retail_min",
      o_orderkey % 100 AS "data-product-ratings_and_reviews-statistics-review_count",
      CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 1 + CAST(o_orderkey % 2 = 0 AS INT) + CAST(o_orderkey % 3 = 0 AS INT) END AS n_children
    FROM facts""",
)
def flat_export(t):
    path, out = work_folder(t.spark, "docs"), work_folder(t.spark, "flat")
    sinks.append_documents(fx.product_documents(t), "doc", path, compression="gzip")
    release(t.spark)  # the documents are written, what was shuffled for them is not needed beside the export
    sinks.export_flat(t.spark, path, out)
    flat = files.read_csv_typed(t.spark, out, string_columns=["_store_id"])
    return flat.select(
        "_store_id",
        "data-product-tcin",
        "data-product-category-name",
        "data-product-category-breadcrumbs",
        "data-product-price-current_retail_min",
        "data-product-ratings_and_reviews-statistics-review_count",
        F.json_array_length("data-product-children").alias("n_children"),
    )


CURATED_SQL = """
SELECT category AS cluster_id, CAST(tcin AS VARCHAR) AS "_tcin", category AS "data-product-category-name", brand AS "data-product-item-primary_brand-name",
  round(reg_retail_max, 6) AS "data-product-price-reg_retail_max", handling AS "data-product-item-handling-import_designation_description"
"""


def _named_products(t):
    return fx.products(t).select(
        F.col("category").alias("cluster_id"),
        F.col("handling").alias("data-product-item-handling-import_designation_description"),
        F.round("reg_retail_max", 6).alias("data-product-price-reg_retail_max"),
        F.col("brand").alias("data-product-item-primary_brand-name"),
        F.col("category").alias("data-product-category-name"),
        F.col("tcin").cast("string").alias("_tcin"),
        F.col("n_code").alias("not_wanted"),
    )


@query("curated_output", f"{CURATED_SQL} FROM ({fx.V1})")
def curated_output(t):
    path = work_folder(t.spark, "enriched")
    sinks.write_enriched(_named_products(t), path)
    back = files.read_csv_typed(t.spark, path, string_columns=["_tcin"])
    return curated(back)


@query(
    "summary_export_roundtrip",
    f"""SELECT category, count(*) AS n, round(max(current_retail_min), 6) AS top_price FROM ({fx.V1}) GROUP BY category""",
)
def summary_export_roundtrip(t):
    path = work_folder(t.spark, "summary")
    table = fx.products(t).groupBy("category").agg(F.count("*").alias("n"), F.max("current_retail_min").alias("top_price"))
    sinks.write_if_wanted(table, path)
    sinks.write_if_wanted(table, None)
    return files.read_csv_typed(t.spark, path).select("category", "n", F.round("top_price", 6).alias("top_price"))
