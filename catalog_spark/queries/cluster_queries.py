"""Distances, neighbours, metrics and fits on the given vectors."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window, functions as F

from ..operators import cluster, features, kselect, lloyd, neighbors, project, summary
from ..plans.catalog import product_report
from ..session import materialize, work_folder
from . import fixtures as fx
from .clean_queries import CLEANED, band_sql, cleaned_products
from .feature_queries import mode_sql
from .registry import query


@query("centroid_distance", f"WITH {fx.DUCK_VECTORS} SELECT vec_id, label AS cluster_id, round(dist, 4) AS cluster_dist FROM own")
def centroid_distance(t):
    rows = fx.vectors(t)
    far = cluster.centroid_distance(rows, cluster.cluster_moments(rows, ["cluster_id"], "vector"))
    return far.select("vec_id", "cluster_id", F.round("cluster_dist", 4).alias("cluster_dist"))


@query(
    "cluster_outlier_flag",
    f"""WITH {fx.DUCK_VECTORS}, cuts AS (SELECT label, quantile_cont(dist, 0.95) AS cut FROM own GROUP BY label)
    SELECT concat('v', vec_id) AS id, CAST(dist > cut AS INTEGER) AS cluster_outlier FROM own JOIN cuts USING (label)
    UNION ALL SELECT concat('e', event_id), CAST(value > cut AS INTEGER) FROM events JOIN (
      SELECT event_type, quantile_cont(value, 0.95) AS cut FROM events GROUP BY event_type) USING (event_type)""",
)
def cluster_outlier_flag(t):
    rows = fx.vectors(t)
    far = cluster.centroid_distance(rows, cluster.cluster_moments(rows, ["cluster_id"], "vector"))
    parts = [
        far.select(F.concat(F.lit("v"), "vec_id").alias("id"), F.concat(F.lit("v"), "cluster_id").alias("cluster_id"), "cluster_dist"),
        t.events.select(F.concat(F.lit("e"), "event_id").alias("id"), F.col("event_type").alias("cluster_id"), F.col("value").alias("cluster_dist")),
    ]
    return summary.outlier_flag(parts[0].unionByName(parts[1])).select("id", "cluster_outlier")


PAIRS = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS id, a.label AS own, b.vec_id AS other, b.label AS label, list_distance(a.e, b.e) AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id)"""


@query(
    "knn_in_cluster",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    near AS (SELECT a.vec_id AS id, b.vec_id AS other, list_distance(a.e, b.e) AS d,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS r FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id)
    SELECT vec_id, """
    + ", ".join(f"max(CASE WHEN r = {i} THEN CAST(other AS VARCHAR) END) AS nn{i}_id, round(max(CASE WHEN r = {i} THEN d END), 4) AS nn{i}_dist" for i in (1, 2, 3))
    + " FROM embeddings LEFT JOIN near ON id = vec_id GROUP BY vec_id",
)
def knn_in_cluster(t):
    rows = fx.vectors(t)
    found = neighbors.nearest_in_cluster(rows, "vec_id", "cluster_id", "vector", k=3)
    wide = neighbors.widen(rows.select("vec_id"), found, "vec_id", 3)
    return wide.withColumns({f"nn{i}_dist": F.round(f"nn{i}_dist", 4) for i in (1, 2, 3)})


@query(
    "nearest_centroid_assign",
    f"""WITH {fx.DUCK_VECTORS}, all_d AS (SELECT vec_id, c.label AS label, sum((x - c) * (x - c)) AS d FROM elements e JOIN centers c ON e.p = c.p GROUP BY vec_id, c.label)
    SELECT vec_id, label AS cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS r FROM all_d) WHERE r = 1""",
)
def nearest_centroid_assign(t):
    rows = fx.vectors(t)
    centers = cluster.cluster_moments(rows, ["cluster_id"], "vector")
    return cluster.assign_nearest(rows.select("vec_id", "vector"), centers).select("vec_id", "cluster_id")


@query("cluster_inertia", f"WITH {fx.DUCK_VECTORS} SELECT label AS cluster_id, count(*) AS n, round(sum(dist * dist), 4) AS within FROM own GROUP BY label")
def cluster_inertia(t):
    moments = cluster.cluster_moments(fx.vectors(t), ["cluster_id"], "vector")
    return moments.select("cluster_id", "n", F.round("within", 4).alias("within"))


SILHOUETTE = """sums AS (SELECT id, own, label, sum(d) AS d, count(*) AS n FROM pairs GROUP BY id, own, label),
ab AS (SELECT id, max(CASE WHEN label = own THEN d / n END) AS a, min(CASE WHEN label <> own THEN d / n END) AS b FROM sums GROUP BY id)"""


@query("silhouette_euclidean", f"WITH {PAIRS}, {SILHOUETTE} SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab")
def silhouette_euclidean(t):
    found = kselect.silhouette(fx.vectors(t), "vec_id", "vector", {10: "cluster_id"})
    return found.select(F.round("silhouette", 6).alias("silhouette"))


SQUARED = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS id, a.label AS own, b.label AS label, list_distance(a.e, b.e) ** 2 AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id)"""


@query("silhouette_squared", f"WITH {SQUARED}, {SILHOUETTE} SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab")
def silhouette_squared(t):
    found = kselect.silhouette_squared(fx.vectors(t), "vector", {10: "cluster_id"})
    return found.select(F.round("silhouette", 6).alias("silhouette"))


@query(
    "calinski_harabasz",
    f"""WITH {fx.DUCK_VECTORS}, sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label), mean AS (SELECT p, avg(x) AS m FROM elements GROUP BY p),
    between_ss AS (SELECT sum(n * (c - m) * (c - m)) AS b FROM centers JOIN sizes USING (label) JOIN mean USING (p)), within_ss AS (SELECT sum(dist * dist) AS w, count(*) AS n FROM own)
    SELECT round((b / ((SELECT count(*) FROM sizes) - 1)) / (w / (n - (SELECT count(*) FROM sizes))), 6) AS calinski_harabasz FROM between_ss, within_ss""",
)
def calinski_harabasz(t):
    table = kselect.partition_metrics(fx.vectors(t), {10: "cluster_id"})
    return table.select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


# Partitions that need no fit: for K the labels K-1 and above are one cluster.
KS = range(2, 11)
DUCK_SCORES = """kc AS (SELECT k, g, p, avg(x) AS c, count(*) AS n FROM cells GROUP BY k, g, p), km AS (SELECT k, p, avg(x) AS m FROM cells GROUP BY k, p),
w AS (SELECT k, sum((x - c) * (x - c)) AS inertia, count(DISTINCT vec_id) AS n, count(DISTINCT g) AS groups FROM cells JOIN kc USING (k, g, p) GROUP BY k),
b AS (SELECT k, sum(n * (c - m) * (c - m)) AS b FROM kc JOIN km USING (k, p) GROUP BY k),
metrics AS (SELECT k, inertia, (b / (groups - 1)) / (inertia / (w.n - groups)) AS ch FROM w JOIN b USING (k)),
pts AS (SELECT k, inertia, (k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER () + 1e-9) AS x, (inertia - min(inertia) OVER ()) / (max(inertia) OVER () - min(inertia) OVER () + 1e-9) AS y FROM metrics),
ends AS (SELECT arg_min(x, k) AS x1, arg_min(y, k) AS y1, arg_max(x, k) - arg_min(x, k) AS dx, arg_max(y, k) - arg_min(y, k) AS dy FROM pts),
elbow AS (SELECT k AS elbow_k FROM (SELECT k, abs((x - x1) * dy - (y - y1) * dx) / sqrt(dx * dx + dy * dy) AS off FROM pts, ends) ORDER BY off DESC, k LIMIT 1)"""
DUCK_METRICS = f"""ks AS (SELECT CAST(unnest(range(2, 11)) AS INTEGER) AS k),
cells AS (SELECT k, least(label, k - 1) AS g, vec_id, p, x FROM (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings), ks),
{DUCK_SCORES}"""


def merged_labels(t):
    labels = {k: f"g{k}" for k in KS}
    return fx.vectors(t).withColumns({c: F.least("cluster_id", F.lit(k - 1)) for k, c in labels.items()}), labels


@query("elbow_k", f"WITH {DUCK_METRICS} SELECT k, round(inertia, 4) AS inertia, elbow_k AS inertia_elbow_k FROM metrics, elbow")
def elbow_k(t):
    rows, labels = merged_labels(t)
    table = materialize(kselect.partition_metrics(rows, labels), "k_metrics")
    elbow = kselect.elbow_k(table).scalar()
    return table.select("k", F.round("inertia", 4).alias("inertia"), elbow.alias("inertia_elbow_k"))


@query("best_k_argmax", f"WITH {DUCK_METRICS} SELECT arg_max(k, ch) AS best_k, round(max(ch), 4) AS top FROM metrics")
def best_k_argmax(t):
    rows, labels = merged_labels(t)
    table = materialize(kselect.partition_metrics(rows, labels), "k_metrics")
    best = summary.arg_max(table, [], "k", "calinski_harabasz", "best_k")
    top = table.agg(F.round(F.max("calinski_harabasz"), 4)).scalar()
    return best.select("best_k", top.alias("top"))


@query(
    "choose_k",
    f"""WITH {DUCK_METRICS}, v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (SELECT a.vec_id AS id, a.label AS la, b.label AS lb, sum(list_distance(a.e, b.e)) AS d, count(*) AS n FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
    sums AS (SELECT k, id, least(la, k - 1) AS own, least(lb, k - 1) AS other, sum(d) AS d, sum(n) AS n FROM pairs, ks GROUP BY 1, 2, 3, 4),
    ab AS (SELECT k, id, max(CASE WHEN own = other THEN d / n END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b FROM sums GROUP BY k, id),
    sil AS (SELECT k, avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS sil FROM ab GROUP BY k),
    norms AS (SELECT k, inertia, sil, ch, elbow_k, (sil - min(sil) OVER ()) / (max(sil) OVER () - min(sil) OVER () + 1e-9) AS sil_norm,
      (ch - min(ch) OVER ()) / (max(ch) OVER () - min(ch) OVER () + 1e-9) AS ch_norm FROM metrics JOIN sil USING (k), elbow),
    scored AS (SELECT *, 0.55 * sil_norm + 0.45 * ch_norm AS score FROM norms),
    best AS (SELECT k AS best_k, score AS best_score FROM scored ORDER BY score DESC, k LIMIT 1), at_elbow AS (SELECT max(score) AS s FROM scored WHERE k = elbow_k)
    SELECT k, round(inertia, 4) AS inertia, round(sil, 6) AS silhouette, round(ch, 4) AS calinski_harabasz, elbow_k AS inertia_elbow_k, round(sil_norm, 5) AS sil_norm,
      round(ch_norm, 5) AS ch_norm, round(score, 5) AS score, CASE WHEN abs(best_k - elbow_k) >= 2 AND s > 0 AND s >= best_score * 0.98 THEN elbow_k ELSE best_k END AS chosen_k
    FROM scored, best, at_elbow""",
)
def choose_k(t):
    rows, labels = merged_labels(t)
    table = kselect.partition_metrics(rows, labels).join(kselect.silhouette(rows, "vec_id", "vector", labels), "k")
    scores = kselect.score_table(materialize(table, "k_metrics"))
    chosen = kselect.choose_k(scores).select("chosen_k").scalar()
    digits = {"inertia": 4, "silhouette": 6, "calinski_harabasz": 4, "sil_norm": 5, "ch_norm": 5, "score": 5}
    return scores.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in scores.columns], chosen.alias("chosen_k"))


def feature_rows(t):
    return fx.vectors(t).withColumn("features", array_to_vector("vector"))


def lloyd_sql(ks: str, restarts: int, steps: int) -> str:
    """Relations ``best`` (k, run) and ``chosen`` (k, vec_id, e, j): Lloyd steps of all restarts of all K, the least cost of each K.

    Starts are rows in the order of a digest of id and restart; a centre without rows stays where it is.
    """
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
        f"ks AS (SELECT unnest({ks}) AS k)",
        f"""first_rows AS MATERIALIZED (SELECT run, e, row_number() OVER (PARTITION BY run ORDER BY md5(concat(vec_id, ':', run)), vec_id) - 1 AS j FROM v, range({restarts}) AS r(run))""",
        "c0 AS MATERIALIZED (SELECT k, run, j, e AS c FROM first_rows JOIN ks ON j < k)",
    ]
    for i in range(steps + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT k, run, vec_id, any_value(e) AS e, min({{'d': list_distance(e, c), 'j': j}}) AS m FROM v, c{i} GROUP BY k, run, vec_id)")
        if i < steps:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.k, o.run, o.j, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
              SELECT k, run, j, list(x ORDER BY p) AS c FROM (SELECT k, run, j, p, avg(x) AS x FROM (SELECT k, run, m.j AS j, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{i}) GROUP BY k, run, j, p) GROUP BY k, run, j
            ) n USING (k, run, j))""")
    parts.append(f"best AS (SELECT k, arg_min(run, (cost, run)) AS run FROM (SELECT k, run, sum(m.d ** 2) AS cost FROM a{steps} GROUP BY k, run) GROUP BY k)")
    parts.append(f"chosen AS MATERIALIZED (SELECT k, vec_id, e, m.j AS j FROM a{steps} JOIN best USING (k, run))")
    return ", ".join(parts)


def by_first_row(assigned, row_id: str):
    """Clusters numbered in the order of their smallest row id, so that a partition has one numbering."""
    first = assigned.groupBy("cluster_id").agg(F.min(row_id).alias("first"))
    numbers = first.select("cluster_id", (F.row_number().over(Window.orderBy("first")) - 1).alias("number"))  # a row a cluster
    return assigned.join(F.broadcast(numbers), "cluster_id").select(row_id, F.col("number").alias("cluster_id"))


@query(
    "kmeans_assign",
    f"""WITH {lloyd_sql('[10]', 20, 10)}, firsts AS (SELECT j, row_number() OVER (ORDER BY min(vec_id)) - 1 AS number FROM chosen GROUP BY j)
    SELECT vec_id, CAST(number AS INTEGER) AS cluster_id FROM chosen JOIN firsts USING (j)""",
)
def kmeans_assign(t):
    """The best of 20 restarts after ten steps each, from rows of the table."""
    rows = materialize(fx.vectors(t).select("vec_id", "vector"), "vectors")
    starts = lloyd.row_starts(rows, [10], cluster.FINAL_RESTARTS, "vec_id")
    fit = lloyd.best_fits(rows, [10], starts, max_iterations=10, tolerance=0.0)[10]
    return by_first_row(rows.select("vec_id", cluster.nearest_center(fit.centers)("vector").alias("cluster_id")), "vec_id")


@query("kmeans_fit")
def kmeans_fit(t):
    """The same from spread starts and until no centre moves."""
    rows = materialize(fx.vectors(t).select("vec_id", "vector"), "vectors")
    return by_first_row(rows.select("vec_id", cluster.nearest_center(cluster.fit_kmeans(rows, 10, "vec_id"))("vector").alias("cluster_id")), "vec_id")


def batches_sql(steps: list[str]) -> str:
    """Relations c1, c2, ... (run, j, c, w) from c0: each step moves the centres by the means of the rows of ``v`` that a condition picks."""
    parts = []
    for i, picked in enumerate(steps):
        parts.append(f"a{i} AS MATERIALIZED (SELECT run, any_value(e) AS e, min({{'d': list_distance(e, c), 'j': j}}) AS m FROM v, c{i} WHERE {picked} GROUP BY run, vec_id)")
        parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.run, o.j, o.w + coalesce(b.n, 0) AS w,
            CASE WHEN b.n IS NULL THEN o.c ELSE list_transform(list_zip(o.c, b.c), lambda p: (p[1] * o.w + p[2] * b.n) / (o.w + b.n)) END AS c
          FROM c{i} o LEFT JOIN (SELECT run, j, list(x ORDER BY p) AS c, any_value(n) AS n FROM (SELECT run, j, p, avg(x) AS x, count(*) AS n FROM (
            SELECT run, m.j AS j, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{i}) GROUP BY run, j, p) GROUP BY run, j) b USING (run, j))""")
    return ", ".join(parts)


@query(
    "minibatch_kmeans_assign",
    f"""WITH v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST('0x' || md5(concat(vec_id, ':42'))[1:8] AS BIGINT) % 8 AS slot FROM embeddings),
    c0 AS MATERIALIZED (SELECT run, j, c, 0 AS w FROM (SELECT run, e AS c, row_number() OVER (PARTITION BY run ORDER BY md5(concat(vec_id, ':', 42 + run)), vec_id) - 1 AS j FROM v, range(20) AS r(run)) WHERE j < 10),
    {batches_sql([f"slot = {b}" for _ in range(3) for b in range(8)])},
    last AS MATERIALIZED (SELECT run, vec_id, min({{'d': list_distance(e, c), 'j': j}}) AS m FROM v, c24 GROUP BY run, vec_id),
    best AS (SELECT arg_min(run, (cost, run)) AS run FROM (SELECT run, sum(m.d ** 2) AS cost FROM last GROUP BY run)),
    firsts AS (SELECT m.j AS j, row_number() OVER (ORDER BY min(vec_id)) - 1 AS number FROM last JOIN best USING (run) GROUP BY m.j)
    SELECT vec_id, CAST(number AS INTEGER) AS cluster_id FROM last JOIN best USING (run) JOIN firsts ON firsts.j = last.m.j""",
)
def minibatch_kmeans_assign(t):
    """Eight batches, three epochs, the best of 20 restarts."""
    rows = materialize(fx.vectors(t).select("vec_id", "vector"), "vectors")
    centers = cluster.fit_minibatch(rows, 10, "vec_id", restarts=cluster.FINAL_RESTARTS)
    return by_first_row(rows.select("vec_id", cluster.nearest_center(centers)("vector").alias("cluster_id")), "vec_id")


@query(
    "k_metrics_table",
    f"""WITH {lloyd_sql('range(2, 21)', 10, 6)},
    cells AS (SELECT k, j AS g, vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM chosen),
    {DUCK_SCORES},
    pairs AS (SELECT a.vec_id AS id, b.vec_id AS other, list_distance(a.e, b.e) ** 2 AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    sums AS (SELECT o.k, id, o.j AS own, c.j AS j, avg(d) AS d FROM pairs JOIN chosen o ON o.vec_id = id JOIN chosen c ON c.vec_id = other AND c.k = o.k GROUP BY ALL),
    ab AS (SELECT k, id, max(CASE WHEN j = own THEN d END) AS a, min(CASE WHEN j <> own THEN d END) AS b FROM sums GROUP BY k, id),
    sil AS (SELECT k, avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS sil FROM ab GROUP BY k),
    norms AS (SELECT k, inertia, sil, ch, elbow_k, (sil - min(sil) OVER ()) / (max(sil) OVER () - min(sil) OVER () + 1e-9) AS sil_norm,
      (ch - min(ch) OVER ()) / (max(ch) OVER () - min(ch) OVER () + 1e-9) AS ch_norm FROM metrics JOIN sil USING (k), elbow)
    SELECT CAST(k AS INTEGER) AS k, round(inertia, 3) AS inertia, round(sil, 6) AS silhouette, round(ch, 4) AS calinski_harabasz, CAST(elbow_k AS INTEGER) AS inertia_elbow_k,
      round(sil_norm, 4) AS sil_norm, round(ch_norm, 4) AS ch_norm, round(0.55 * sil_norm + 0.45 * ch_norm, 4) AS score FROM norms""",
)
def k_metrics_table(t):
    """K from 2 to 20 with 10 restarts each, six steps from rows of the table."""
    rows = materialize(fx.vectors(t).select("vec_id", "vector"), "vectors")
    ks = list(range(2, 21))
    starts = lloyd.row_starts(rows, ks, cluster.SWEEP_RESTARTS, "vec_id")
    models = {k: f.centers for k, f in lloyd.best_fits(rows, ks, starts, max_iterations=6, tolerance=0.0).items()}
    table = kselect.metrics_of(rows, models, "vec_id", "vector")
    digits = {"inertia": 3, "silhouette": 6, "calinski_harabasz": 4, "sil_norm": 4, "ch_norm": 4, "score": 4}
    return table.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in table.columns])


def components_sql(k: int, squarings: int = 18) -> str:
    """Relations ``v`` (vec_id, e) and ``scores`` (vec_id, c, x): the rows times the ``k`` leading eigenvectors of their products.

    A power of the Gram matrix by repeated squaring has the leading eigenvector in its columns; it is then taken out.
    """
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    cells AS MATERIALIZED (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
    g0 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS x FROM cells a JOIN cells b USING (vec_id) GROUP BY ALL)"""
    ]
    for c in range(k):
        last = f"g{c}"
        for s in range(squarings):
            parts.append(f"p{c}_{s} AS MATERIALIZED (SELECT i, j, x / max(abs(x)) OVER () AS x FROM (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY ALL))")
            last = f"p{c}_{s}"
        parts.append(
            f"""u{c} AS MATERIALIZED (SELECT i, x / sqrt(sum(x * x) OVER ()) * sign(max_by(x, abs(x)) OVER ()) AS x FROM {last}
      WHERE j = (SELECT j FROM {last} GROUP BY j ORDER BY sum(x * x) DESC LIMIT 1)),
    l{c} AS MATERIALIZED (SELECT sum(a.x * g{c}.x * b.x) AS x FROM g{c} JOIN u{c} a USING (i) JOIN u{c} b ON g{c}.j = b.i),
    g{c + 1} AS MATERIALIZED (SELECT g{c}.i, j, g{c}.x - l{c}.x * a.x * b.x AS x FROM g{c} JOIN u{c} a USING (i) JOIN u{c} b ON g{c}.j = b.i, l{c})"""
        )
    scores = " UNION ALL ".join(f"SELECT vec_id, {c} AS c, sum(cells.x * u.x) AS x FROM cells JOIN u{c} u USING (i) GROUP BY vec_id" for c in range(k))
    return ",\n    ".join([*parts, f"scores AS MATERIALIZED ({scores})"])


@query("svd_reduce", f"WITH {components_sql(8)} SELECT vec_id, {', '.join(f'round(sum(x) FILTER (c = {c}), 6) AS svd_{c}' for c in range(8))} FROM scores GROUP BY vec_id")
def svd_reduce(t):
    rows = feature_rows(t)
    reduced = project.fit_svd(rows, 8, "vec_id").transform(rows, "vec_id")
    return reduced.select("vec_id", *[F.round(F.get("reduced", F.lit(i)), 6).alias(f"svd_{i}") for i in range(8)])


@query(
    "svd_full_rank",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT v.vec_id, round(sqrt(list_sum(list_transform(v.e, lambda x: x * x))), 6) AS norm, round(list_distance(v.e, f.e), 6) AS to_first
    FROM v, (SELECT e FROM v ORDER BY vec_id LIMIT 1) f""",
)
def svd_full_rank(t):
    """Reduced to as many dimensions as there are, rows keep their norms and distances."""
    rows = feature_rows(t)
    dims = features.vector_size(rows, "features")
    reduced = project.fit_svd(rows, dims, "vec_id").transform(rows, "vec_id")
    first = reduced.orderBy("vec_id").limit(1).select("reduced").scalar()
    norm = lambda v: F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), 6)
    return reduced.withColumn("f", first).select("vec_id", norm(F.col("reduced")).alias("norm"), norm(F.zip_with("reduced", "f", lambda a, b: a - b)).alias("to_first"))


@query("project_2d", f"WITH {components_sql(2)} SELECT vec_id, round(sum(x) FILTER (c = 0), 6) AS proj_x, round(sum(x) FILTER (c = 1), 6) AS proj_y FROM scores GROUP BY vec_id")
def project_2d(t):
    flat = project.project_2d(feature_rows(t), "vec_id")
    return flat.select("vec_id", F.round("proj_x", 6).alias("proj_x"), F.round("proj_y", 6).alias("proj_y"))


@query(
    "stream_minibatch_centroids",
    f"""WITH v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    c0 AS MATERIALIZED (SELECT 0 AS run, j, c, 0 AS w FROM (
      SELECT e AS c, row_number() OVER (ORDER BY md5(concat(vec_id, ':42')), vec_id) - 1 AS j FROM (SELECT e, min(vec_id) AS vec_id FROM v WHERE vec_id % 4 = 0 GROUP BY e)) WHERE j < 10),
    {batches_sql([f"vec_id % 4 = {b}" for b in range(4)])}
    SELECT vec_id, CAST(min({{'d': list_distance(e, c), 'j': j}}).j AS INTEGER) AS cluster_id FROM v, c4 GROUP BY vec_id""",
)
def stream_minibatch_centroids(t):
    """The vectors arrive in four files; each is one batch."""
    from ..streaming.centroids import read_state, track_centroids

    source, state, checkpoint = (work_folder(t.spark, n) for n in ("arrivals", "state", "progress"))
    for b in range(4):
        t.embeddings.where(F.col("vec_id") % 4 == b).coalesce(1).write.mode("append").parquet(source)
    track_centroids(t.spark, source, t.embeddings.schema, state, checkpoint, 10, "vec_id", "embedding", max_files=1).awaitTermination()
    centers, _ = read_state(t.spark, state)
    rows = fx.vectors(t)
    return rows.select("vec_id", cluster.nearest_center(np.asarray(centers))("vector").alias("cluster_id"))


@query(
    "category_report",
    f"""WITH p AS (SELECT *, {band_sql('reg_retail_max')} AS band FROM ({CLEANED}))
    SELECT category, count(*) AS n, round(quantile_cont(reg_retail_max, 0.5), 6) AS median_price,
      round(avg(CASE WHEN tariff_risk = 1 THEN 1.0 ELSE 0.0 END), 6) AS imported_share, any_value(m.band) AS main_band
    FROM p JOIN {mode_sql('category', 'band', 'SELECT * FROM p')} m USING (category) GROUP BY category""",
)
def category_report(t):
    return product_report(cleaned_products(t), "category", "reg_retail_max")
