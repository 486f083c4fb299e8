"""Aggregations, profiles and feature blocks."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.clean import canonical_origin
from ..functions.text import corpus
from ..functions.vectors import nonfinite_entries
from ..operators import cluster, features, fitted, profile, summary, tfidf
from ..operators.quantiles import group_mode, group_quantile
from ..session import materialize, release, work_folder
from . import fixtures as fx
from .clean_queries import CLEANED, DUCK_TOKENS, cleaned_products, origin_sql, strip_sql
from .registry import query


@query(
    "cluster_summary",
    f"""SELECT category AS cluster_id, count(*) AS n, min(brand) AS label, round(quantile_cont(reg_retail_max, 0.5), 6) AS median_price,
      round(avg(CASE WHEN tariff_risk = 1 THEN 1.0 ELSE 0.0 END), 6) AS imported_share, round(avg(CASE WHEN height > 15 THEN 1.0 ELSE 0.0 END), 6) AS outlier_rate
    FROM ({CLEANED}) GROUP BY category""",
)
def cluster_summary(t):
    rows = cleaned_products(t).withColumn("flag", (F.col("height") > 15).cast("int")).withColumnRenamed("category", "cluster_id")
    table = summary.cluster_summary(rows, label="brand", price="reg_retail_max", outlier="flag")
    return table.withColumns({c: F.round(c, 6) for c in ["median_price", "imported_share", "outlier_rate"]})


def mode_sql(k: str, v: str, src: str) -> str:
    return f"""(SELECT {k}, {v} FROM (SELECT {k}, {v}, row_number() OVER (PARTITION BY {k} ORDER BY ({v} IS NULL), count(*) DESC, {v}) AS r
      FROM ({src}) GROUP BY {k}, {v}) WHERE r = 1)"""


@query(
    "group_mode",
    f"""WITH p AS (SELECT *, {origin_sql('handling')} AS origin, CASE WHEN category <> 'PROMO' THEN brand END AS known FROM ({fx.V1}))
    SELECT 'brand' AS what, category AS grp, known AS value FROM {mode_sql('category', 'known', 'SELECT * FROM p')}
    UNION ALL SELECT 'origin', CAST(height AS VARCHAR), origin FROM {mode_sql('height', 'origin', 'SELECT * FROM p')}""",
)
def group_modes(t):
    rows = fx.products(t).withColumn("origin", canonical_origin(F.col("handling")))
    rows = rows.withColumn("known", F.when(F.col("category") != "PROMO", F.col("brand")))
    brand = group_mode(rows, ["category"], "known", "value").select(F.lit("brand").alias("what"), F.col("category").alias("grp"), "value")
    origin = group_mode(rows, ["height"], "origin", "value").select(F.lit("origin").alias("what"), F.col("height").cast("string").alias("grp"), "value")
    return brand.unionByName(origin)


@query(
    "cluster_label",
    f"""SELECT tcin, height AS cluster_id, m.category AS cluster_label FROM ({fx.V1}) p LEFT JOIN {mode_sql('height', 'category', fx.V1)} m USING (height)""",
)
def cluster_label(t):
    rows = fx.products(t).select("tcin", F.col("height").alias("cluster_id"), F.col("category").alias("data-product-category-name"))
    from ..operators.relate import attach_label

    return attach_label(rows, summary.group_labels(rows)).select("tcin", "cluster_id", "cluster_label")


NUMERIC = ["current_retail_min", "reg_retail_max", "reg_retail_text", "depth", "height", "width"]


def number_sql(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)" if c == "reg_retail_text" else f"CAST({c} AS DOUBLE)"


FILLED = f"""filled AS (SELECT tcin, {', '.join(f'coalesce(v.{c}, m.{c}) AS {c}' for c in NUMERIC)}
  FROM (SELECT tcin, {', '.join(f'{number_sql(c)} AS {c}' for c in NUMERIC)} FROM ({fx.V1})) v,
  (SELECT {', '.join(f'quantile_cont({number_sql(c)}, 0.5) AS {c}' for c in NUMERIC)} FROM ({fx.V1})) m)"""


def numeric_products(t):
    return fx.products(t).select("tcin", *NUMERIC, F.lit(None).cast("double").alias("empty"), F.lit(7.0).alias("fixed"))


@query("median_impute", f"WITH {FILLED} SELECT tcin, {', '.join(f'round({c}, 6) AS {c}' for c in NUMERIC)} FROM filled")
def median_impute(t):
    rows = fx.products(t)
    fit = features.fit_numeric(rows, NUMERIC)
    medians = dict(zip(fit.columns, fit.medians))
    values = features.as_numbers(rows, NUMERIC)
    return rows.select("tcin", *[F.round(F.coalesce(v, F.lit(medians[c])), 6).alias(c) for v, c in zip(values, NUMERIC)])


@query(
    "numeric_scale",
    f"""WITH {FILLED}, d AS (SELECT {', '.join(f'stddev_pop({c}) AS {c}' for c in NUMERIC)} FROM filled)
    SELECT tcin, {', '.join(f'round(filled.{c} / d.{c}, 6) AS num__{c}' for c in NUMERIC)}, CAST(7 AS DOUBLE) AS num__fixed FROM filled, d""",
)
def numeric_scale(t):
    """The all-null column is dropped, the constant one stays as it is."""
    rows = numeric_products(t)
    fit = features.fit_numeric(rows, [*NUMERIC, "empty", "fixed"])
    return fit.transform(rows).select("tcin", *[F.round(n, 6).alias(n) for n in fit.feature_names])


CATEGORICAL = ["brand", "fine", "handling"]
V1_FINE = f"SELECT *, concat(title, '/', depth) AS fine FROM ({fx.V1})"
LEVELS = f"""levels AS (SELECT column_name, level, count(*) AS n FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, coalesce({c}, '__null__') AS level FROM ({V1_FINE})" for c in CATEGORICAL)}) GROUP BY 1, 2),
pooled AS (SELECT column_name, level, n, CASE WHEN n >= 5 THEN level ELSE '__infrequent__' END AS pooled FROM levels)"""
ONE_HOT = f"""hot AS (SELECT tcin, concat('cat__', column_name, '_', pooled) AS feature, CAST(1 AS DOUBLE) AS value FROM (
  {' UNION ALL '.join(f"SELECT tcin, '{c}' AS column_name, coalesce({c}, '__null__') AS level FROM ({V1_FINE})" for c in CATEGORICAL)}) JOIN pooled USING (column_name, level))"""


def categorical_products(t):
    """Title and depth together are rare enough to fall under the least frequency."""
    return fx.products(t).withColumn("fine", F.concat("title", F.lit("/"), "depth"))


@query("category_min_frequency", f"WITH {LEVELS} SELECT * FROM pooled")
def category_min_frequency(t):
    return features.category_counts(categorical_products(t), CATEGORICAL)


@query("one_hot_long", f"WITH {LEVELS}, {ONE_HOT} SELECT * FROM hot")
def one_hot_long(t):
    rows = categorical_products(t)
    return features.fit_categories(rows, CATEGORICAL).long(rows, "tcin")


@query(
    "weighted_assemble",
    f"""WITH {FILLED}, {LEVELS}, {ONE_HOT}, d AS (SELECT {', '.join(f'stddev_pop({c}) AS {c}' for c in NUMERIC)} FROM filled),
    cells AS ({' UNION ALL '.join(f"SELECT tcin, 'num__{c}' AS feature, 0.7 * filled.{c} / d.{c} AS value FROM filled, d" for c in NUMERIC)}
      UNION ALL SELECT tcin, feature, 1.5 * value FROM hot)
    SELECT tcin, count(*) AS n, round(sum(value), 5) AS total, round(max(value), 5) AS top FROM cells GROUP BY tcin""",
)
def weighted_assemble(t):
    rows = categorical_products(t)
    numbers = features.fit_numeric(rows, NUMERIC).long(rows, "tcin")
    hot = features.fit_categories(rows, CATEGORICAL).long(rows, "tcin")
    cells = features.weighted_long([(numbers, 0.7), (None, 9.0), (hot, 1.5)])
    return cells.groupBy("tcin").agg(F.count("*").alias("n"), F.round(F.sum("value"), 5).alias("total"), F.round(F.max("value"), 5).alias("top"))


@query(
    "feature_dictionary",
    f"""WITH {LEVELS}, names AS (
      {' UNION ALL '.join(f"SELECT 1 AS b, {i} AS c, '' AS s, 'num__{n}' AS feature, 'num' AS block" for i, n in enumerate(NUMERIC))}
      UNION ALL SELECT DISTINCT 2, CASE column_name WHEN 'brand' THEN 0 WHEN 'fine' THEN 1 ELSE 2 END, CASE WHEN pooled = '__infrequent__' THEN '~' ELSE pooled END,
        concat('cat__', column_name, '_', pooled), 'cat' FROM pooled
      UNION ALL SELECT 3, 0, term, concat('txt__', term), 'txt' FROM (
        SELECT term FROM (SELECT DISTINCT tcin, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, greatest(len(w), 1))])) AS term
          FROM (SELECT tcin, {DUCK_TOKENS.format('title')} AS w FROM ({fx.V1}))) GROUP BY term HAVING count(*) >= 3))
    SELECT CAST(row_number() OVER (ORDER BY b, c, s) - 1 AS INTEGER) AS position, feature, block FROM names""",
)
def feature_dictionary(t):
    rows = categorical_products(t)
    numbers = features.fit_numeric(rows, NUMERIC)
    categories = features.fit_categories(rows, CATEGORICAL)
    terms = tfidf.fit_tfidf(tfidf.term_counts(rows, "tcin", "title"), rows.count()).vocabulary
    return features.feature_dictionary(numbers.feature_names, categories, terms, rows)


def terms_sql(table: str, row_id: str) -> str:
    """(row_id, term, tf) of uni- and bigrams."""
    return f"""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, greatest(len(w), 1))])) AS term
      FROM (SELECT {row_id} AS id, {DUCK_TOKENS.format('text')} AS w FROM {table})) GROUP BY id, term"""


VOCABULARY = f"""counts AS ({terms_sql('documents', 'doc_id')}),
vocabulary AS (SELECT term, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM (
  SELECT term, count(*) AS df, sum(tf) AS total FROM counts GROUP BY term HAVING count(*) >= 3))"""


@query(
    "tfidf_weights",
    f"""WITH {VOCABULARY}, raw AS (SELECT id, term, df, idf, tf * idf AS w FROM counts JOIN vocabulary USING (term)),
    unit AS (SELECT id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY id)
    SELECT term, max(df) AS df, round(max(idf), 6) AS idf, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS top
    FROM raw JOIN unit USING (id) GROUP BY term""",
)
def tfidf_weights(t):
    """All weights of all documents, reported per term; added up in shares of the documents, so that one share at a time is shuffled."""
    counts = tfidf.term_counts(t.spread("documents", "doc_id"), "doc_id", "text", tfidf.text_bytes(t.documents, "text"), grouped=True)
    fit = tfidf.fit_tfidf(counts, t.documents.count())
    shares = []
    for share in counts.split():
        found = fit.long(share, "doc_id", terms=False).groupBy("position").agg(F.sum("weight").alias("total"), F.max("weight").alias("top"))
        shares.append(materialize(found, "weights"))
        del found
        release(t.spark)
    weights = reduce(DataFrame.union, shares).groupBy("position").agg(F.sum("total").alias("total"), F.max("top").alias("top"))
    return fit.join(weights).select(
        "term", "df", F.round("idf", 6).alias("idf"), F.round("total", 6).alias("total"), F.round("top", 6).alias("top")
    )


@query(
    "tfidf_apply",
    f"""WITH {VOCABULARY}, seen AS ({terms_sql('conversations', "concat(conv_id, ':', turn)")}),
    raw AS (SELECT id, term, tf * idf AS w FROM seen JOIN vocabulary USING (term)), unit AS (SELECT id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY id)
    SELECT id, count(*) AS n, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS top FROM raw JOIN unit USING (id) GROUP BY id""",
)
def tfidf_apply(t):
    """Fitted on the documents, applied to the turns of the conversations."""
    counts = tfidf.term_counts(t.spread("documents", "doc_id"), "doc_id", "text", tfidf.text_bytes(t.documents, "text"))
    fit = tfidf.fit_tfidf(counts, t.documents.count())
    turns = t.conversations.select(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("id"), "text")
    weights = fit.long(tfidf.term_counts(turns, "id", "text"), "id")
    return weights.groupBy("id").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("total"), F.round(F.max("weight"), 6).alias("top"))


def long_features_sql(table: str, row_id: str, level: str) -> str:
    """Features (id, f, value) of ``table`` by the numbers, levels and terms fitted on the documents."""
    strip = f"(SELECT *, {strip_sql('text')} AS s FROM {table})"
    return f"""SELECT {row_id} AS id, 'n' AS f, 0.5 * coalesce(length(text), med) / dev AS value FROM {table}, scale
      UNION ALL SELECT {row_id}, concat('c:', l.pooled), 0.8 FROM {table} t JOIN levels l ON l.level = coalesce(t.{level}, '__null__')
      UNION ALL SELECT id, concat('t:', term), 1.5 * w / sqrt(sum(w * w) OVER (PARTITION BY id)) FROM (
        SELECT id, term, tf * idf AS w FROM ({terms_sql(strip, row_id).replace("lower(text)", "lower(s)")}) JOIN top_terms USING (term))"""


@query(
    "fitted_model_apply",
    f"""WITH {VOCABULARY.replace("lower(text)", f"lower({strip_sql('text')})")},
    top_terms AS (SELECT v.* FROM vocabulary v JOIN (SELECT term, sum(tf) AS total FROM counts GROUP BY term) USING (term) ORDER BY total DESC, term LIMIT 2000),
    scale AS (SELECT med, stddev_pop(coalesce(length(text), med)) AS dev FROM documents, (SELECT quantile_cont(length(text), 0.5) AS med FROM documents) GROUP BY med),
    levels AS (SELECT coalesce(source, '__null__') AS level, CASE WHEN count(*) >= 5 THEN coalesce(source, '__null__') ELSE '__infrequent__' END AS pooled FROM documents GROUP BY 1, source),
    x AS MATERIALIZED ({long_features_sql('documents', 'doc_id', 'source')}),
    size AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang) - 1 AS cluster_id FROM documents WHERE lang IS NOT NULL GROUP BY lang),
    centers AS MATERIALIZED (SELECT cluster_id, f, sum(value) / any_value(n) AS value FROM x JOIN documents ON doc_id = id JOIN size USING (lang) GROUP BY cluster_id, f),
    y AS MATERIALIZED ({long_features_sql("(SELECT concat(conv_id, ':', turn) AS id, role AS source, text FROM conversations)", 'id', 'source')}),
    far AS (SELECT id, cluster_id, xx + cc - 2 * coalesce(xc, 0) AS d2 FROM (SELECT id, sum(value * value) AS xx FROM y GROUP BY id)
      CROSS JOIN (SELECT cluster_id, sum(value * value) AS cc FROM centers GROUP BY cluster_id)
      LEFT JOIN (SELECT id, cluster_id, sum(y.value * c.value) AS xc FROM y JOIN centers c USING (f) GROUP BY id, cluster_id) USING (id, cluster_id))
    SELECT id, CAST(min_by(cluster_id, d2) AS INTEGER) AS cluster_id, round(sqrt(min(d2)), 4) AS cluster_dist FROM far GROUP BY id""",
)
def fitted_model_apply(t):
    """Length, source and terms fitted on the documents, a centre for each language; kept, read back, and applied to the turns."""
    docs = t.spread("documents", "doc_id").withColumn("length", F.char_length("text").cast("double"))
    texts = docs.select("doc_id", corpus([F.col("text")]).alias("text"))
    counts = tfidf.term_counts(texts, "doc_id", "text", tfidf.text_bytes(t.documents, "text"))
    terms = tfidf.fit_tfidf(materialize(counts, "counts"), docs.count(), max_features=2_000)
    model = fitted.FittedModel(features.fit_numeric(docs, ["length"]), features.fit_categories(docs, ["source"]), ("text",), terms, weights=(0.5, 0.8, 1.5))
    rows = model.vectors(docs, "doc_id").join(docs.select("doc_id", "lang").where("lang is not null"), "doc_id")
    centers = cluster.cluster_moments(rows, ["lang"], "features").select((F.rank().over(Window.orderBy("lang")) - 1).cast("int").alias("cluster_id"), "center")
    path = work_folder(t.spark, "model")
    fitted.save(replace(model, centers=centers), path, t.spark)
    turn = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    turns = t.conversations.select(turn.alias("id"), F.char_length("text").cast("double").alias("length"), F.col("role").alias("source"), "text")
    return fitted.load(t.spark, path).score(turns, "id").select("id", "cluster_id", F.round("cluster_dist", 4).alias("cluster_dist"))


@query(
    "embedding_block_join",
    """SELECT doc_id, lang, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total
    FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
)
def embedding_block_join(t):
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = features.join_embeddings(t.documents.select("doc_id", "lang"), vectors, "doc_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", "lang", F.size("embedding").cast("bigint").alias("dims"), F.round(total, 5).alias("total"))


@query(
    "group_p95",
    """SELECT event_type AS grp, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type
    UNION ALL SELECT CAST(c_nationkey AS VARCHAR), round(quantile_cont(c_acctbal, 0.95), 6) FROM customer GROUP BY c_nationkey""",
)
def group_p95(t):
    events = t.events.select(F.col("event_type").alias("grp"), "value")
    balances = t.customer.select(F.col("c_nationkey").cast("string").alias("grp"), F.col("c_acctbal").alias("value"))
    cuts = group_quantile(events.unionByName(balances), ["grp"], "value", 0.95, "p95")
    return cuts.withColumn("p95", F.round("p95", 6))


@query("minmax_normalize", "SELECT event_id, round((value - lo) / (hi - lo + 1e-9), 6) AS scaled, CAST(0 AS DOUBLE) AS flat FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events)")
def minmax_normalize(t):
    rows = t.events.select("event_id", "value", F.lit(3.0).alias("same"))
    scaled = summary.min_max_scale(summary.min_max_scale(rows, "value", "scaled"), "same", "flat")
    return scaled.select("event_id", F.round("scaled", 6).alias("scaled"), "flat")


PROFILED = ["current_retail_min", "current_retail", "reg_retail_max", "width", "handling", "brand"]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null, round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 4) AS percent,
        (SELECT string_agg(tcin, ',' ORDER BY tcin) FROM (SELECT tcin FROM ({fx.V1}) WHERE {c} IS NULL ORDER BY tcin LIMIT 5)) AS examples FROM ({fx.V1})"""
        for c in PROFILED
        if c != "brand"
    ),
)
def null_profile(t):
    return profile.null_profile(fx.products(t), "tcin", PROFILED)


@query(
    "inf_profile",
    """SELECT 'value' AS column_name, count(*) FILTER (event_id % 50 = 0) AS n_inf, round(100.0::DOUBLE * count(*) FILTER (event_id % 50 = 0) / count(*), 4) AS percent,
    (SELECT string_agg(event_id, ',' ORDER BY event_id) FROM (SELECT event_id FROM events WHERE event_id % 50 = 0 ORDER BY event_id LIMIT 5)) AS examples FROM events""",
)
def inf_profile(t):
    broken = F.when(F.col("event_id") % 100 == 0, F.lit(float("inf"))).when(F.col("event_id") % 50 == 0, F.lit(float("-inf")))
    rows = t.events.select("event_id", F.coalesce(broken, "value").alias("value"), F.col("value").alias("fine"))
    return profile.inf_profile(rows, "event_id")


@query(
    "feature_nonfinite_audit",
    """WITH cells AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings),
    bad AS (SELECT vec_id, concat('f', p) AS feature, CASE WHEN (vec_id + p) % 97 = 0 THEN 'nan' WHEN (vec_id + 3 * p) % 89 = 0 THEN 'inf' END AS kind FROM cells),
    ranked AS (SELECT kind, feature, count(*) AS n, CAST(row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, feature) AS INTEGER) AS rank FROM bad WHERE kind IS NOT NULL GROUP BY kind, feature),
    shown AS (SELECT kind, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id, feature) AS examples FROM (
      SELECT *, row_number() OVER (PARTITION BY kind ORDER BY vec_id, feature) AS r FROM bad WHERE kind IS NOT NULL) WHERE r <= 5 GROUP BY kind)
    SELECT kind, feature, n, rank, examples FROM ranked JOIN shown USING (kind) WHERE rank <= 25""",
)
def feature_nonfinite_audit(t):
    def broken(x, p):
        bad = F.when((F.col("vec_id") + p) % 97 == 0, F.lit(float("nan"))).when((F.col("vec_id") + 3 * p) % 89 == 0, F.lit(float("-inf")))
        return F.coalesce(bad, x.cast("double"))

    matrix = t.embeddings.select(F.col("vec_id").alias("row_id"), array_to_vector(F.transform("embedding", broken)).alias("features"))
    cells = nonfinite_entries(matrix, "row_id").withColumn("feature", F.concat(F.lit("f"), "position"))
    return profile.nonfinite_features(cells)
