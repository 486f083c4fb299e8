"""Views over the given tables that stand in for product data; the SQL texts serve both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import as_double
from .registry import Tables

PRODUCTS = """
SELECT p_partkey AS tcin, p_name AS title, p_type AS category, p_brand AS brand,
  concat('x/N-', lower(replace(p_brand, 'Brand#', 'b')), '?q=1') AS n_code,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice / 10 END AS current_retail_min,
  CASE WHEN p_partkey % 22 = 0 THEN NULL ELSE p_retailprice / 10 + 1 END AS current_retail,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice * (p_partkey % 29) / 20 END AS reg_retail_max,
  CASE WHEN p_partkey % 7 = 0 THEN 'n/a' WHEN p_partkey % 7 = 1 THEN '' ELSE concat(' ', p_size, '.5 ') END AS reg_retail_text,
  p_size AS depth, p_partkey % 17 + 1 AS height,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey % 5 + 1 END AS width,
  CASE p_partkey % 9 WHEN 0 THEN 'Made in the USA' WHEN 1 THEN 'Imported'
    WHEN 2 THEN 'Made in the USA & Imported' WHEN 3 THEN 'Assembled in the USA' WHEN 4 THEN NULL
    WHEN 5 THEN '  ' WHEN 6 THEN 'FOREIGN/domestic' WHEN 7 THEN ' MADE IN  THE USA '
    ELSE 'not specified' END AS handling
FROM {part}
"""

STORE_ITEMS = """
SELECT l_suppkey AS store_id, l_partkey AS tcin, l_shipdate AS fetched_at, l_orderkey, l_linenumber FROM {lineitem}
"""

RAW_LINES = """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN concat('{{bad ', props)
  WHEN event_id % 10 = 1 THEN '' WHEN event_id % 10 = 2 THEN concat('  ', props, ' ')
  WHEN event_id % 10 = 3 THEN replace(props, '"', '''')
  WHEN event_id % 10 = 4 THEN concat('plain ', event_type)
  ELSE props END AS line FROM {events}
"""

# One row per order, as the documents below are built from it.
ORDER_FACTS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, c_acctbal, c_mktsegment, n_name, r_name
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# The children of each document in relational form: what the JSON must give back.
CHILDREN = """
SELECT o_orderkey, 1 AS pos, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice / 2 ELSE o_totalprice END AS price,
  o_orderpriority AS brand, CASE WHEN o_orderstatus = 'F' THEN 'Imported' ELSE 'Made in the USA' END AS handling,
  o_orderkey % 12 AS quantity FROM facts WHERE o_orderkey % 5 <> 0
UNION ALL
SELECT o_orderkey, 2, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE c_acctbal END, c_mktsegment, 'Made in the USA', 5
FROM facts WHERE o_orderkey % 5 <> 0 AND o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, 3, NULL, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE c_mktsegment END, NULL, NULL
FROM facts WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0
"""


def duck(text: str) -> str:
    """The text with plain table names, for the oracle."""
    names = ["part", "lineitem", "events", "orders", "customer", "nation", "region"]
    return text.format(**{n: n for n in names})


V1, V2, V5, FACTS = duck(PRODUCTS), duck(STORE_ITEMS), duck(RAW_LINES), duck(ORDER_FACTS)
WITH_CHILDREN = f"WITH facts AS ({FACTS}), children AS ({CHILDREN})"


def products(t: Tables) -> DataFrame:
    return t.sql(PRODUCTS, part=t.part)


def store_items(t: Tables) -> DataFrame:
    return t.sql(STORE_ITEMS, lineitem=t.lineitem)


def raw_lines(t: Tables) -> DataFrame:
    return t.sql(RAW_LINES, events=t.events)


def product_documents(t: Tables) -> DataFrame:
    """(o_orderkey, doc): one product document per order, as JSON text with nulls kept."""
    facts = t.sql(ORDER_FACTS, orders=t.spread("orders", "o_orderkey"), customer=t.customer, nation=t.nation, region=t.region)
    key = F.col("o_orderkey")
    text = lambda c: c.cast("string")

    def child(pos, current, reg, brand, handling, bullets):
        return F.struct(
            F.concat(text(key), F.lit(f"-{pos}")).alias("tcin"),
            F.struct(current.cast("string").alias("current_retail"), reg.cast("double").alias("reg_retail")).alias("price"),
            F.struct(
                F.struct(brand.alias("name")).alias("primary_brand"),
                F.struct(handling.cast("string").alias("import_designation_description")).alias("handling"),
                F.struct(bullets.cast("array<string>").alias("bullet_descriptions")).alias("product_description"),
            ).alias("item"),
        )

    none = F.lit(None)
    first = child(
        1, F.when(key % 4 != 0, F.col("o_totalprice")), F.col("o_totalprice") / 2, F.col("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", "Imported").otherwise("Made in the USA"),
        F.array(F.lit("Soft"), F.concat(F.lit("Package Quantity: "), text(key % 12)), F.lit("Package Quantity: 99")),
    )
    second = child(
        2, F.when(key % 6 == 0, F.lit("n/a")).otherwise(text(F.col("c_acctbal"))), none, F.col("c_mktsegment"),
        F.lit("Made in the USA"), F.array(F.lit("package quantity:5")),
    )
    third = child(3, none, none, F.when(key % 7 == 0, "").otherwise(F.col("c_mktsegment")), none, none)
    children = F.array_compact(
        F.array(F.when(key % 5 != 0, first), F.when((key % 5 != 0) & (key % 2 == 0), second), F.when((key % 5 != 0) & (key % 3 == 0), third))
    )
    crumb = lambda c: F.struct(c.alias("name"))
    crumbs = F.when(key % 8 == 0, F.array(crumb(F.col("r_name")), crumb(none.cast("string")))).otherwise(
        F.array(crumb(F.col("r_name")), crumb(F.col("n_name")))
    )
    average = lambda name, value: F.struct(F.lit(name).alias("id"), value.alias("value"))
    averages = F.when(key % 9 == 0, F.array(average("value", (key % 40) / 10))).otherwise(
        F.array(average("quality", (key % 50) / 10), average("value", (key % 40) / 10))
    )
    product = F.struct(
        key.alias("tcin"),
        F.struct(F.col("c_mktsegment").alias("name"), crumbs.alias("breadcrumbs")).alias("category"),
        F.struct(F.struct(averages.alias("secondary_averages"), (key % 100).alias("review_count")).alias("statistics")).alias("ratings_and_reviews"),
        F.struct(F.when(key % 3 != 0, F.col("o_totalprice")).alias("current_retail_min")).alias("price"),
        children.alias("children"),
    )
    doc = F.struct(
        text(F.col("o_custkey")).alias("_store_id"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit(" "), text(key))).alias("_tcin"),
        F.when(key % 6 == 0, F.lit(0)).when(key % 6 == 3, key + 1000000).alias("tcin"),
        F.struct(product.alias("product")).alias("data"),
    )
    return facts.select(key, F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))


def vectors(t: Tables) -> DataFrame:
    """(vec_id, cluster_id, vector) with the given label as cluster."""
    return t.embeddings.select("vec_id", F.col("label").alias("cluster_id"), as_double(F.col("embedding")).alias("vector"))


# Elements, centroids and own-centroid distances of the vectors, for the oracles.
DUCK_VECTORS = """
elements AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings),
centers AS (SELECT label, p, avg(x) AS c FROM elements GROUP BY label, p),
own AS (SELECT vec_id, label, sqrt(sum((x - c) * (x - c))) AS dist FROM elements JOIN centers USING (label, p) GROUP BY vec_id, label)
"""
