"""Flattening, extraction and tolerant parsing of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import numeric
from ..operators import embedded, flatten
from ..session import materialize
from . import fixtures as fx
from .registry import query

CRUMBS = """concat('[{"name":"', r_name, '"},{"name":', CASE WHEN o_orderkey % 8 = 0 THEN 'null' ELSE concat('"', n_name, '"') END, '}]')"""


@query(
    "flatten_dash",
    f"""WITH facts AS ({fx.FACTS})
    SELECT CAST(o_custkey AS VARCHAR) AS "_store_id", CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN concat(' ', o_orderkey) END AS "_tcin",
      o_orderkey AS "data-product-tcin", c_mktsegment AS "data-product-category-name", {CRUMBS} AS "data-product-category-breadcrumbs",
      CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS "data-product-price-current_retail_min",
      o_orderkey % 100 AS "data-product-ratings_and_reviews-statistics-review_count",
      CASE WHEN o_orderkey % 6 = 0 THEN 0 WHEN o_orderkey % 6 = 3 THEN o_orderkey + 1000000 END AS tcin
    FROM facts""",
)
def flatten_dash(t):
    flat = flatten.flatten_json(materialize(fx.product_documents(t).select("doc"), "documents"), "doc")
    lists = ["data-product-children", "data-product-ratings_and_reviews-statistics-secondary_averages"]
    return flat.drop(*lists)


ODD = """
SELECT concat('{{"id":', o_orderkey, ',"odd  key.v":"', o_orderstatus, '"', CASE WHEN o_orderkey % 5 = 0 THEN concat(',"Odd  key.v":', o_custkey) ELSE '' END,
  CASE WHEN o_orderkey % 4 = 0 THEN concat(',"a.b":', o_orderkey) ELSE '' END, ',"a":{{"b":', CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE CAST(o_custkey AS STRING) END, ',"none":{{}}}}',
  CASE WHEN o_orderkey % 4 = 2 THEN concat(',"a.b":', o_orderkey) ELSE '' END, '}}') AS doc FROM {orders}
"""


@query(
    "flatten_key_normalize",
    """SELECT o_orderkey AS id, o_orderstatus AS "odd_key-v__2", CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS "Odd_key-v",
      CASE WHEN o_orderkey % 4 = 2 THEN o_orderkey WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS "a-b" FROM orders""",
)
def flatten_key_normalize(t):
    """Two paths to one name, in either order and null, and two keys that differ in case."""
    return flatten.flatten_json(t.sql(ODD, orders=t.spread("orders", "o_orderkey")), "doc")


@query(
    "array_to_json_text",
    f"""WITH facts AS ({fx.FACTS})
    SELECT o_orderkey, {CRUMBS} AS crumbs, concat('[', o_custkey, ',null,"', o_orderstatus, '"]') AS mixed FROM facts""",
)
def array_to_json_text(t):
    facts = t.sql(fx.ORDER_FACTS, orders=t.spread("orders", "o_orderkey"), customer=t.customer, nation=t.nation, region=t.region)
    crumb = lambda c: F.struct(c.alias("name"))
    second = F.when(F.col("o_orderkey") % 8 != 0, F.col("n_name"))
    crumbs = flatten.array_text(F.array(crumb(F.col("r_name")), crumb(second)))
    mixed = F.concat(F.lit('{"mixed": [ '), "o_custkey", F.lit(' , null, "'), "o_orderstatus", F.lit('"]}'))
    rows = facts.select("o_orderkey", crumbs.alias("crumbs"), mixed.alias("doc"))
    return flatten.flatten_json(rows, "doc", ["o_orderkey", "crumbs"])


@query(
    "union_of_keys",
    """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice, NULL AS s_suppkey, NULL AS s_name, NULL AS s_acctbal FROM part
    UNION ALL SELECT NULL, NULL, NULL, NULL, s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_of_keys(t):
    part = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    supplier = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    docs = [df.select(F.to_json(F.struct("*")).alias("doc")) for df in (part, supplier)]
    return flatten.flatten_json(flatten.union_of_keys(docs), "doc")


@query(
    "nested_array_explode",
    f"""{fx.WITH_CHILDREN} SELECT o_orderkey, concat(o_orderkey, '-', pos) AS tcin, brand FROM children""",
)
def nested_array_explode(t):
    element = "struct<tcin:string,item:struct<primary_brand:struct<name:string>>>"
    path = ("data", "product", "children")
    rows = flatten.explode_path(fx.product_documents(t), "doc", path, element, ["o_orderkey"])
    return rows.select("o_orderkey", "item.tcin", F.col("item.item.primary_brand.name").alias("brand"))


@query(
    "recursive_key_values",
    f"""{fx.WITH_CHILDREN}, found AS (
      SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS value FROM facts
      UNION SELECT o_custkey, concat(o_orderkey, '-', pos) FROM children JOIN facts USING (o_orderkey)
      UNION SELECT o_custkey, CASE WHEN o_orderkey % 6 = 0 THEN '0' ELSE CAST(o_orderkey + 1000000 AS VARCHAR) END FROM facts WHERE o_orderkey % 3 = 0)
    SELECT CAST(o_custkey AS VARCHAR) AS store_id, count(*) AS n, min(value) AS first_value, max(value) AS last_value FROM found GROUP BY o_custkey""",
)
def recursive_key_values(t):
    docs = fx.product_documents(t).withColumn("store_id", F.get_json_object("doc", "$._store_id"))
    found = flatten.key_values(docs, "doc", "tcin", ["store_id"])
    return found.groupBy("store_id").agg(F.count("*").alias("n"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))


@query(
    "multi_path_key",
    f"""WITH facts AS ({fx.FACTS})
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS store_id, CASE WHEN o_orderkey = 0 THEN '' WHEN o_orderkey % 6 = 3 THEN CAST(o_orderkey + 1000000 AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS tcin FROM facts""",
)
def multi_path_key(t):
    """The number 0 is no key, so order 0 has none."""
    from ..streaming.ingest import ITEM_PATHS, STORE_PATHS

    docs = fx.product_documents(t).withColumn("v", F.try_parse_json("doc"))
    return docs.select(
        "o_orderkey",
        flatten.first_filled(F.col("v"), STORE_PATHS).alias("store_id"),
        flatten.first_filled(F.col("v"), ITEM_PATHS).alias("tcin"),
    )


@query(
    "detect_json_columns",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, coalesce(bool_or(regexp_matches({c}, '^\\s*[\\[{{]')), false) AS is_json FROM {table}"
        for table, columns in {"events": ["event_type", "props"], "documents": ["text", "lang", "source"], "pages": ["url", "html"]}.items()
        for c in columns
    ),
)
def detect_json_columns(t):
    parts = [embedded.detect_json_columns(df).withColumn("table_name", F.lit(n)) for n, df in [("events", t.events), ("documents", t.documents), ("pages", t.pages)]]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "parse_embedded_json",
    """SELECT event_id, CASE WHEN event_id % 10 IN (0, 1, 4) THEN NULL ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k,
      CASE event_id % 10 WHEN 0 THEN concat('{bad ', props) WHEN 4 THEN concat('plain ', event_type) END AS text, CAST(event_id % 10 = 1 AS INTEGER) AS blank
    FROM events""",
)
def parse_embedded_json(t):
    parsed = fx.raw_lines(t).withColumn("v", embedded.parse_embedded(F.col("line")))
    is_text = F.schema_of_variant("v") == "STRING"
    return parsed.select(
        "event_id",
        F.try_variant_get("v", "$.k", "bigint").alias("k"),
        F.when(is_text, F.variant_get("v", "$", "string")).alias("text"),
        F.col("v").isNull().cast("int").alias("blank"),
    )


def _product(t, path: str, parse):
    text = F.get_json_object("doc", f"$.data.product.{path}")
    return fx.product_documents(t).select("o_orderkey", parse(text).alias("x"))


@query(
    "breadcrumb_path",
    f"""WITH facts AS ({fx.FACTS}) SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN r_name ELSE concat(r_name, ' > ', n_name) END AS category_path FROM facts""",
)
def breadcrumb_path(t):
    rows = _product(t, "category.breadcrumbs", embedded.breadcrumbs)
    return rows.select("o_orderkey", embedded.breadcrumb_path(F.col("x")).alias("category_path"))


@query(
    "keyed_array_lookup",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey % 50) / 10 END AS rating_quality, (o_orderkey % 40) / 10 AS rating_value FROM orders""",
)
def keyed_array_lookup(t):
    rows = _product(t, "ratings_and_reviews.statistics.secondary_averages", embedded.secondary_averages)
    return rows.select(
        "o_orderkey",
        embedded.keyed_value(F.col("x"), "quality").alias("rating_quality"),
        embedded.keyed_value(F.col("x"), "value").alias("rating_value"),
    )


def _mode_sql(column: str) -> str:
    return f"""{column}_mode AS (SELECT o_orderkey, {column} FROM (SELECT o_orderkey, {column},
      row_number() OVER (PARTITION BY o_orderkey ORDER BY count(*) DESC, {column}) AS r FROM children
      WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) <> '' GROUP BY o_orderkey, {column}) WHERE r = 1)"""


@query(
    "children_rollup",
    f"""{fx.WITH_CHILDREN}, prices AS (SELECT o_orderkey, min(price) AS lo, max(price) AS hi FROM children GROUP BY o_orderkey),
    {_mode_sql('brand')}, {_mode_sql('handling')}, {_mode_sql('quantity')}
    SELECT o_orderkey, round(lo, 4) AS children_price_min, round(hi, 4) AS children_price_max, brand AS children_brand_mode,
      handling AS children_handling_mode, CAST(quantity AS BIGINT) AS children_pkg_qty_mode
    FROM facts LEFT JOIN prices USING (o_orderkey) LEFT JOIN brand_mode USING (o_orderkey) LEFT JOIN handling_mode USING (o_orderkey)
    LEFT JOIN quantity_mode USING (o_orderkey)""",
)
def children_rollup(t):
    rows = _product(t, "children", embedded.children)
    columns = embedded.children_rollup(F.col("x"))
    rounded = {c: F.round(v, 4) if "price" in c else v for c, v in columns.items()}
    return rows.select("o_orderkey", *[v.alias(c) for c, v in rounded.items()])


@query(
    "package_quantity",
    f"""{fx.WITH_CHILDREN} SELECT o_orderkey, count(quantity) AS n, coalesce(string_agg(CAST(quantity AS VARCHAR), ',' ORDER BY pos), '') AS quantities
    FROM facts LEFT JOIN children USING (o_orderkey) GROUP BY o_orderkey""",
)
def package_quantity(t):
    rows = _product(t, "children", embedded.children)
    found = embedded.package_quantities(F.col("x"))
    return rows.select("o_orderkey", F.size(found).cast("bigint").alias("n"), F.array_join(found.cast("array<string>"), ",").alias("quantities"))


@query(
    "numeric_coerce",
    f"""SELECT tcin, TRY_CAST(trim(reg_retail_text) AS DOUBLE) AS from_text, TRY_CAST(brand AS DOUBLE) AS from_brand,
      TRY_CAST(replace(brand, 'Brand#', '') AS DOUBLE) AS from_digits FROM ({fx.V1})""",
)
def numeric_coerce(t):
    digits = F.replace(F.col("brand"), F.lit("Brand#"), F.lit(""))
    return fx.products(t).select(
        "tcin", numeric(F.col("reg_retail_text")).alias("from_text"), numeric(F.col("brand")).alias("from_brand"), numeric(digits).alias("from_digits")
    )
