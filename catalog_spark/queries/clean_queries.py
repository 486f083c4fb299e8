"""Projections, cleaning and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..functions import clean, text
from ..operators import relate
from ..session import spread
from . import fixtures as fx
from .registry import query

TITLE = r"""array_to_string([upper(x[1]) || lower(x[2:]) for x in regexp_extract_all({0}, '(\p{{L}}+|\P{{L}}+)')], '')"""


def origin_sql(column: str) -> str:
    t = f"replace(regexp_replace(replace(lower(trim({column})), '&', 'and'), '\\s+', ' ', 'g'), ' the usa', ' usa')"
    title = TITLE.format(f"trim({column})")
    return f"""CASE WHEN {column} IS NULL OR trim({column}) = '' THEN NULL
      WHEN contains({t}, 'assem') AND contains({t}, 'usa') THEN 'Assembled in USA (foreign/domestic parts)'
      WHEN contains({t}, 'made') AND contains({t}, 'usa') AND contains({t}, 'import') THEN 'Made in USA and Imported'
      WHEN contains({t}, 'made') AND contains({t}, 'usa') THEN 'Made in USA'
      WHEN contains({t}, 'import') THEN 'Imported' ELSE {title} END"""


def risk_sql(column: str) -> str:
    return f"""CASE WHEN lower({column}) LIKE '%import%' OR lower({column}) LIKE '%foreign%' OR lower({column}) LIKE '%assembled%' THEN 1
      WHEN lower({column}) LIKE '%usa%' THEN 0 END"""


def band_sql(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 10 THEN '<$10' WHEN {x} <= 25 THEN '$10–25' WHEN {x} <= 50 THEN '$25–50'
      WHEN {x} <= 100 THEN '$50–100' WHEN {x} <= 250 THEN '$100–250' WHEN {x} <= 500 THEN '$250–500'
      WHEN {x} <= 1000 THEN '$500–1000' ELSE '>$1000' END"""


# Products with canonical origin, a second origin column and the risk flag.
CLEANED = f"""
SELECT *, coalesce({risk_sql('origin')}, {risk_sql('second')}, 0) AS tariff_risk FROM (
  SELECT *, {origin_sql('handling')} AS origin, {origin_sql("CASE WHEN depth % 3 = 0 THEN 'imported goods' WHEN depth % 3 = 1 THEN 'usa/mexico don''t' END")} AS second
  FROM ({fx.V1}))
"""
SECOND = "CASE WHEN depth % 3 = 0 THEN 'imported goods' WHEN depth % 3 = 1 THEN 'usa/mexico don''t' END"


def cleaned_products(t):
    rows = fx.products(t).withColumn("second", F.expr(SECOND))
    rows = rows.withColumns({"origin": clean.canonical_origin(F.col("handling")), "second": clean.canonical_origin(F.col("second"))})
    return rows.withColumn("tariff_risk", clean.tariff_risk([F.col("origin"), F.col("second")]))


@query("tolerant_projection", f"SELECT tcin, brand, category FROM ({fx.V1})")
def tolerant_projection(t):
    return spec.select_present(fx.products(t), ["tcin", "absent_column", "brand", "another-one", "category"])


@query("blank_key_filter", f"SELECT tcin, trim(handling) AS handling FROM ({fx.V1}) WHERE trim(handling) <> ''")
def blank_key_filter(t):
    return relate.drop_blank_keys(fx.products(t), ["handling"]).select("tcin", "handling")


@query(
    "provenance_enrich",
    f"""SELECT store_id, count(*) AS n, min(_store_id) AS store_kept, max(_fetched_at) AS fetched, CAST(sum(CAST(_tcin AS BIGINT)) AS BIGINT) AS tcins
    FROM (SELECT store_id, concat('S', store_id) AS _store_id, CAST(tcin AS VARCHAR) AS _tcin, '2024-01-01T00:00:00' AS _fetched_at FROM ({fx.V2})) GROUP BY store_id""",
)
def provenance_enrich(t):
    """The payload keeps its own ``_store_id``; the fetch time comes in as a parameter."""
    items = fx.store_items(t).withColumn("_store_id", F.concat(F.lit("S"), "store_id"))
    context = {"_store_id": F.lit("context"), "_tcin": F.col("tcin").cast("string"), "_fetched_at": F.lit("context time")}
    rows = relate.with_provenance(items, context, payload_wins=True)
    rows = relate.with_provenance(rows, {"_fetched_at": F.lit("2024-01-01T00:00:00")}, payload_wins=False)
    return rows.groupBy("store_id").agg(
        F.count("*").alias("n"),
        F.min("_store_id").alias("store_kept"),
        F.max("_fetched_at").alias("fetched"),
        F.sum(F.col("_tcin").cast("bigint")).alias("tcins"),
    )


@query(
    "feature_spec_columns",
    f"""SELECT round(current_retail_min, 6) AS "data-product-price-current_retail_min", CAST(depth AS DOUBLE) / 2 AS rating_quality, depth * height * width AS pkg_volume_lwh,
      CAST(width IS NULL AS INTEGER) AS pkg_volume_lwh__missing, CAST(current_retail_min IS NULL AS INTEGER) AS "data-product-price-current_retail_min__missing",
      brand AS "data-product-item-primary_brand-name", title AS "data-product-item-product_description-title", category AS category_path FROM ({fx.V1})""",
)
def feature_spec_columns(t):
    names = {
        "current_retail_min": "data-product-price-current_retail_min",
        "brand": "data-product-item-primary_brand-name",
        "title": "data-product-item-product_description-title",
        "category": "category_path",
        **dict(zip(["depth", "height", "width"], spec.DIMENSIONS)),
    }
    rows = fx.products(t).withColumn("current_retail_min", F.round("current_retail_min", 6)).withColumnsRenamed(names)
    rows = rows.withColumn("rating_quality", F.col(spec.DIMENSIONS[0]) * 0.5)
    volume = F.col(spec.DIMENSIONS[0]) * F.col(spec.DIMENSIONS[1]) * F.col(spec.DIMENSIONS[2])
    rows = rows.withColumn("pkg_volume_lwh", volume)
    rows = rows.withColumns({spec.missing(c): clean.missing_flag(F.col(c)) for c in ["pkg_volume_lwh", "data-product-price-current_retail_min"]})
    found = spec.FeatureSpec.from_options().resolve(rows)
    return rows.select(*found.numeric, *found.categorical, *found.text)


@query("id_column_choice", f"SELECT CAST(tcin AS VARCHAR) AS item_id, brand FROM ({fx.V1})")
def id_column_choice(t):
    rows = fx.products(t).withColumnRenamed("tcin", "data-product-item-dpci")
    return rows.select(spec.item_id(rows).alias("item_id"), "brand")


@query("canonical_origin", f"SELECT tcin, origin, second FROM ({CLEANED})")
def canonical_origin(t):
    return cleaned_products(t).select("tcin", "origin", "second")


@query("tariff_risk", f"SELECT tcin, tariff_risk FROM ({CLEANED})")
def tariff_risk(t):
    return cleaned_products(t).select("tcin", "tariff_risk")


@query(
    "price_band",
    f"""SELECT concat('p', tcin) AS id, {band_sql('reg_retail_max')} AS price_band FROM ({fx.V1})
    UNION ALL SELECT concat('e', event_id), {band_sql('value')} FROM events UNION ALL SELECT concat('c', c_custkey), {band_sql('c_acctbal')} FROM customer""",
)
def price_band(t):
    parts = [("p", "tcin", "reg_retail_max", fx.products(t)), ("e", "event_id", "value", t.events), ("c", "c_custkey", "c_acctbal", t.customer)]
    rows = [df.select(F.concat(F.lit(p), k).alias("id"), clean.price_band(F.col(x)).alias("price_band")) for p, k, x, df in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "price_fallback",
    f"""SELECT tcin, round(coalesce(current_retail_min, current_retail, TRY_CAST(trim(reg_retail_text) AS DOUBLE)), 6) AS price_min,
      round(coalesce(reg_retail_max, TRY_CAST(trim(reg_retail_text) AS DOUBLE)), 6) AS price_max FROM ({fx.V1})""",
)
def price_fallback(t):
    from ..plans.cleaning import price_chain

    rows = fx.products(t)
    low = price_chain(rows, ("current_retail_min", "current_retail", "reg_retail_text"))
    high = price_chain(rows, ("reg_retail_max", "not_there", "reg_retail_text"))
    return rows.select("tcin", F.round(low, 6).alias("price_min"), F.round(high, 6).alias("price_max"))


@query(
    "missing_flags",
    f"""SELECT tcin, CAST(coalesce(current_retail_min, current_retail) IS NULL AS INTEGER) AS price__missing, CAST(width IS NULL AS INTEGER) AS width__missing,
      CAST(TRY_CAST(trim(reg_retail_text) AS DOUBLE) IS NULL AS INTEGER) AS text__missing FROM ({fx.V1})""",
)
def missing_flags(t):
    return fx.products(t).select(
        "tcin",
        clean.missing_flag(F.coalesce("current_retail_min", "current_retail")).alias("price__missing"),
        clean.missing_flag(F.col("width")).alias("width__missing"),
        clean.missing_flag(clean.numeric(F.col("reg_retail_text"))).alias("text__missing"),
    )


@query("package_volume", f"SELECT tcin, CAST(depth * height * width AS DOUBLE) AS pkg_volume_lwh, CAST(width IS NULL AS INTEGER) AS pkg_volume_lwh__missing FROM ({fx.V1})")
def package_volume(t):
    from ..plans.cleaning import add_volume

    return add_volume(fx.products(t), ("depth", "height", "width")).select("tcin", "pkg_volume_lwh", "pkg_volume_lwh__missing")


SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]+"


def strip_sql(c: str) -> str:
    """Entities of the pages (the ampersand last, as one pass would), tags, bullets, whitespace."""
    s = c
    for entity, char in [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]:
        s = f"replace({s}, '{entity}', '{char}')"
    return f"trim(regexp_replace(regexp_replace(regexp_replace({s}, '<[^>]+>', ' ', 'g'), '&bull;|•', ' ', 'g'), '{SPACES}', ' ', 'g'))"


@query(
    "html_strip",
    f"""SELECT concat('p', page_id) AS id, length({strip_sql('html')}) AS n, md5({strip_sql('html')}) AS digest FROM pages
    UNION ALL SELECT concat('d', doc_id), length({strip_sql('text')}), md5({strip_sql('text')}) FROM documents""",
)
def html_strip(t):
    parts = [("p", "page_id", "html", t.spread("pages", "page_id")), ("d", "doc_id", "text", t.spread("documents", "doc_id"))]
    rows = [df.select(F.concat(F.lit(p), k).alias("id"), text.strip_html(F.col(c)).alias("s")) for p, k, c, df in parts]
    return rows[0].unionByName(rows[1]).select("id", F.length("s").cast("bigint").alias("n"), F.md5("s").alias("digest"))


@query(
    "text_corpus",
    f"""SELECT tcin, length(corpus) AS n, md5(corpus) AS digest FROM (
      SELECT tcin, concat_ws(' ' || chr(10) || ' ', {strip_sql('title')}, {strip_sql('handling')}, {strip_sql('text')}, {strip_sql('html')}) AS corpus
      FROM ({fx.V1}) LEFT JOIN documents ON doc_id = tcin LEFT JOIN pages ON page_id = tcin)""",
)
def text_corpus(t):
    docs = t.documents.select(F.col("doc_id").alias("tcin"), "text")
    pages = t.pages.select(F.col("page_id").alias("tcin"), "html")
    rows = spread(fx.products(t), "tcin").join(docs, "tcin", "left").join(pages, "tcin", "left")
    rows = rows.select("tcin", text.corpus([F.col(c) for c in ["title", "handling", "text", "html"]]).alias("corpus"))
    return rows.select("tcin", F.length("corpus").cast("bigint").alias("n"), F.md5("corpus").alias("digest"))


# Word characters with accents removed, the same class on both sides.
DUCK_TOKENS = r"regexp_extract_all(strip_accents(lower({0})), '[\p{{L}}\p{{N}}_]{{2,}}')"


@query(
    "tokenize_ngrams",
    f"""WITH w AS (SELECT doc_id, {DUCK_TOKENS.format('text')} AS words FROM documents),
    b AS (SELECT doc_id, words, [words[i] || ' ' || words[i + 1] for i in range(1, greatest(len(words), 1))] AS pairs FROM w)
    SELECT doc_id, len(words) AS n_words, len(pairs) AS n_pairs, md5(array_to_string(words, '|')) AS word_digest, md5(array_to_string(pairs, '|')) AS pair_digest FROM b""",
)
def tokenize_ngrams(t):
    words = t.spread("documents", "doc_id").select("doc_id", text.tokens(F.col("text")).alias("w"))
    rows = words.withColumn("b", text.bigrams(F.col("w")))
    return rows.select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_words"),
        F.size("b").cast("bigint").alias("n_pairs"),
        F.md5(F.array_join("w", "|")).alias("word_digest"),
        F.md5(F.array_join("b", "|")).alias("pair_digest"),
    )


@query("iso_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events")
def iso_timestamp(t):
    return t.events.select("event_id", clean.iso_second(F.col("ts")).alias("at"))
