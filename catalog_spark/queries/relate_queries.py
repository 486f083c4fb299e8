"""Deduplication, joins, set operations, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import iso_second
from ..operators import relate, summary
from ..operators.quantiles import group_mode
from ..session import spread, work_folder
from ..sources import sinks
from . import fixtures as fx
from .registry import query

ORDER = "fetched_at, l_orderkey, l_linenumber, tcin, store_id"
STORED = "fetched_at < TIMESTAMP '1996-01-01 00:00:00'"
ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"


def order():
    return [F.col(c.strip()) for c in ORDER.split(",")]


def split(t):
    """(stored, incoming): what was loaded before the cut, and a delivery that repeats it."""
    items = fx.store_items(t)
    return items.where(F.col("fetched_at") < F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'")), items


@query(
    "dedup_first_seen",
    f"""SELECT tcin, store_id, {ISO.format('fetched_at')} AS fetched_at, l_orderkey, l_linenumber FROM (
      SELECT *, row_number() OVER (PARTITION BY tcin ORDER BY {ORDER}) AS r FROM ({fx.V2})) WHERE r = 1""",
)
def dedup_first_seen(t):
    first = relate.first_per_key(fx.store_items(t), ["tcin"], order())
    return first.select("tcin", "store_id", iso_second(F.col("fetched_at")).alias("fetched_at"), "l_orderkey", "l_linenumber")


NEW = f"""new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id, tcin ORDER BY {ORDER}) AS r FROM ({fx.V2})) WHERE r = 1
  AND (store_id, tcin) NOT IN (SELECT (store_id, tcin) FROM ({fx.V2}) WHERE {STORED}))"""


@query(
    "incremental_anti_join",
    f"""WITH {NEW} SELECT store_id, count(*) AS n, CAST(sum(tcin) AS BIGINT) AS tcins, {ISO.format('min(fetched_at)')} AS first_at FROM new GROUP BY store_id""",
)
def incremental_anti_join(t):
    stored, incoming = split(t)
    new = relate.new_rows(incoming, stored, ["store_id", "tcin"], order())
    return new.groupBy("store_id").agg(F.count("*").alias("n"), F.sum("tcin").alias("tcins"), iso_second(F.min("fetched_at")).alias("first_at"))


@query(
    "incremental_merge",
    f"""WITH {NEW}, merged AS (SELECT store_id, tcin FROM ({fx.V2}) WHERE {STORED} UNION ALL SELECT store_id, tcin FROM new)
    SELECT store_id, count(*) AS n, CAST(sum(tcin) AS BIGINT) AS tcins FROM merged GROUP BY store_id""",
)
def incremental_merge(t):
    stored, incoming = split(t)
    merged = relate.merge_new(stored, incoming, ["store_id", "tcin"], order())
    return merged.groupBy("store_id").agg(F.count("*").alias("n"), F.sum("tcin").alias("tcins"))


@query("new_rows_per_key", f"WITH {NEW} SELECT store_id, count(*) AS new_count FROM new GROUP BY store_id")
def new_rows_per_key(t):
    stored, incoming = split(t)
    return relate.rows_per_key(relate.new_rows(incoming, stored, ["store_id", "tcin"], order()), ["store_id"])


SLICES = f"SELECT store_id, p_type AS category, tcin, fetched_at, l_orderkey, l_linenumber FROM ({fx.V2}) JOIN part ON p_partkey = tcin"


def slices(t):
    parts = t.part.select(F.col("p_partkey").alias("tcin"), F.col("p_type").alias("category"))
    return relate.align_skewed(fx.store_items(t), parts, ["tcin"], "inner")


@query(
    "distinct_items_per_slice",
    f"""SELECT store_id, category, count(*) AS n, CAST(sum(tcin) AS BIGINT) AS tcins, {ISO.format('max(fetched_at)')} AS last_first FROM (
      SELECT store_id, category, tcin, min(fetched_at) AS fetched_at FROM ({SLICES}) GROUP BY store_id, category, tcin) GROUP BY store_id, category""",
)
def distinct_items_per_slice(t):
    items = relate.distinct_items(slices(t), ["store_id", "category", "tcin"], order())
    return items.groupBy("store_id", "category").agg(
        F.count("*").alias("n"), F.sum("tcin").alias("tcins"), iso_second(F.max("fetched_at")).alias("last_first")
    )


@query(
    "per_group_limit",
    f"""SELECT store_id, category, tcin FROM (SELECT *, row_number() OVER (PARTITION BY store_id, category ORDER BY tcin) AS r
      FROM (SELECT DISTINCT store_id, category, tcin FROM ({SLICES}))) WHERE r <= 3""",
)
def per_group_limit(t):
    items = slices(t).select("store_id", "category", "tcin").distinct()
    return relate.first_per_key(items, ["store_id", "category"], [F.col("tcin")], n=3)


@query("duplicate_key_audit", f"SELECT store_id, tcin, count(*) AS n FROM ({fx.V2}) GROUP BY store_id, tcin HAVING count(*) > 1")
def duplicate_key_audit(t):
    return relate.duplicate_keys(fx.store_items(t), ["store_id", "tcin"])


@query("distinct_key_count", f"SELECT count(*) AS n_keys FROM (SELECT DISTINCT store_id, tcin FROM ({fx.V2}))")
def distinct_key_count(t):
    return relate.distinct_count(fx.store_items(t), ["store_id", "tcin"])


@query(
    "worklist_cross_join",
    f"""SELECT s_suppkey AS store_id, category, count(*) AS n_pages, min(o) AS first_offset, max(o) AS last_offset
    FROM supplier, (SELECT DISTINCT p_type AS category FROM part), (SELECT CAST(unnest(range(0, 1200, 24)) AS INTEGER) AS o)
    WHERE (s_suppkey, category) NOT IN (SELECT (store_id, category) FROM ({SLICES}) GROUP BY store_id, category HAVING count(*) >= 100)
    GROUP BY s_suppkey, category""",
)
def worklist_cross_join(t):
    """Pairs of store and category that hold at least 100 rows count as collected."""
    stores = t.supplier.select(F.col("s_suppkey").alias("store_id"))
    categories = t.part.select(F.col("p_type").alias("category")).distinct()
    collected = slices(t).groupBy("store_id", "category").count().where("count >= 100")
    work = relate.unseen(relate.worklist(stores, categories), collected, ["store_id", "category"])
    return relate.page_plan(work, step=24, last=1199).groupBy("store_id", "category").agg(
        F.count("*").alias("n_pages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


MODE = """(SELECT {k}, {v} FROM (SELECT {k}, {v}, row_number() OVER (PARTITION BY {k} ORDER BY count(*) DESC, {v}) AS r
  FROM ({src}) WHERE {v} IS NOT NULL GROUP BY {k}, {v}) WHERE r = 1)"""


@query(
    "label_broadcast_join",
    f"""SELECT p.tcin, p.category, m.brand AS cluster_label FROM ({fx.V1}) p LEFT JOIN {MODE.format(k='category', v='brand', src=fx.V1)} m USING (category)""",
)
def label_broadcast_join(t):
    rows = fx.products(t).select("tcin", "category", "brand")
    labels = group_mode(rows, ["category"], "brand", "cluster_label")
    return relate.attach_label(rows, labels, "category").select("tcin", "category", "cluster_label")


@query("row_aligned_join", f"SELECT tcin, brand, depth * height AS area, upper(title) AS loud FROM ({fx.V1})")
def row_aligned_join(t):
    rows = fx.products(t)
    derived = rows.select("tcin", (F.col("depth") * F.col("height")).alias("area"), F.upper("title").alias("loud"))
    return relate.align(rows.select("tcin", "brand"), derived, ["tcin"])


@query(
    "set_union_except",
    f"""WITH a AS (SELECT store_id, tcin FROM ({fx.V2}) WHERE {STORED}), b AS (SELECT store_id, tcin FROM ({fx.V2}) WHERE NOT ({STORED})),
    u AS (SELECT * FROM a UNION SELECT * FROM b), d AS (SELECT * FROM b EXCEPT SELECT * FROM a)
    SELECT store_id, n_union, coalesce(n_new, 0) AS n_new FROM (SELECT store_id, count(*) AS n_union FROM u GROUP BY store_id)
    LEFT JOIN (SELECT store_id, count(*) AS n_new FROM d GROUP BY store_id) USING (store_id)""",
)
def set_union_except(t):
    stored, incoming = split(t)
    pairs = ["store_id", "tcin"]
    late = incoming.where(F.col("fetched_at") >= F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'")).select(*pairs)
    union = relate.union_existing_new(stored.select(*pairs), late).withColumn("is_new", F.lit(0))
    fresh = relate.unseen(late.distinct(), stored, pairs).withColumn("is_new", F.lit(1))
    both = union.unionByName(fresh)
    return both.groupBy("store_id").agg(F.count_if(F.col("is_new") == 0).alias("n_union"), F.count_if(F.col("is_new") == 1).alias("n_new"))


@query(
    "minmax_agg",
    f"""SELECT store_id, round(min(reg_retail_max), 6) AS price_min, round(max(reg_retail_max), 6) AS price_max
    FROM ({fx.V2}) JOIN ({fx.V1}) USING (tcin) GROUP BY store_id""",
)
def minmax_agg(t):
    prices = fx.products(t).select("tcin", "reg_retail_max")
    joined = relate.align_skewed(fx.store_items(t).select("store_id", "tcin"), prices, ["tcin"], "inner")
    return joined.groupBy("store_id").agg(F.round(F.min("reg_retail_max"), 6).alias("price_min"), F.round(F.max("reg_retail_max"), 6).alias("price_max"))


@query(
    "multi_key_rank",
    f"""SELECT tcin, row_number() OVER (ORDER BY depth DESC NULLS LAST, current_retail_min ASC NULLS LAST, tcin) AS rank FROM ({fx.V1})""",
)
def multi_key_rank(t):
    by = [F.col("depth").desc_nulls_last(), F.col("current_retail_min").asc_nulls_last(), F.col("tcin").asc()]
    return summary.rank_rows(fx.products(t), by).select("tcin", "rank")


@query("limit_n", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50")
def limit_n(t):
    return summary.head(t.customer.select("c_custkey", "c_name"), [F.col("c_custkey")], 50)


@query("seeded_sample", f"SELECT tcin, brand FROM ({fx.V1}) ORDER BY md5(concat(tcin, ':42')), tcin LIMIT 150")
def seeded_sample(t):
    return summary.seeded_sample(fx.products(t).select("tcin", "brand"), F.col("tcin"), 150, seed=42)


@query("top_offenders", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 25")
def top_offenders(t):
    return summary.top_counts(t.events, "user_id", 25)


@query("stream_dedup_ingest", f"SELECT CAST(store_id AS VARCHAR) AS store_id, count(DISTINCT tcin) AS n, CAST(sum(DISTINCT tcin) AS BIGINT) AS tcins FROM ({fx.V2}) GROUP BY store_id")
def stream_dedup_ingest(t):
    """Two overlapping drops of JSON lines, ingested by two runs that share a checkpoint."""
    from ..streaming.ingest import ingest_new

    source, sink, checkpoint = (work_folder(t.spark, n) for n in ("drop", "sink", "progress"))
    items = spread(fx.store_items(t), "store_id", "tcin").select(F.col("store_id").cast("string").alias("_store_id"), F.col("tcin").cast("string").alias("_tcin"), iso_second(F.col("fetched_at")).alias("_fetched_at"))
    for drop in (items.where(F.col("_fetched_at") < "1997"), items.where(F.col("_fetched_at") >= "1995")):
        sinks.append_jsonl(drop, source)
        ingest_new(t.spark, source, sink, checkpoint).awaitTermination()
    stored = t.spark.read.parquet(sink)
    return stored.groupBy("store_id").agg(F.count("*").alias("n"), F.sum(F.col("tcin").cast("bigint")).alias("tcins"))
