"""Clustering job: cleaned products to feature vectors, clusters, diagnostics and summary."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from .. import spec
from ..functions.text import corpus
from ..functions.vectors import nonfinite_entries
from ..operators import cluster, embedded, features, fitted, kselect, neighbors, profile, project, relate, summary, tfidf
from ..session import materialize, ship_package
from ..sources.sinks import write_enriched, write_if_wanted
from .cleaning import add_price_band, clean_products

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ClusterOptions:
    """Settings of one run; ``k`` fixes the number of clusters, else it is chosen within ``auto_k``."""

    k: int | None = None
    auto_k: tuple[int, int] = (2, 20)
    seed: int = 42
    sample: int = 0
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    numeric: str | None = None
    categorical: str | None = None
    text: str | None = None
    text_mode: str = "tfidf"  # or "encoder", or "none"
    max_features: int = 12_000  # width of the text block
    min_df: int | float = tfidf.MIN_DF
    svd_dimensions: int = project.SVD_DIMENSIONS
    minibatch: bool = False
    neighbors: int = 3
    distinct_item: bool = False
    projection: bool = False
    sweep_restarts: int = cluster.SWEEP_RESTARTS
    final_restarts: int = cluster.FINAL_RESTARTS
    approximate_cuts: bool = False


@dataclass(frozen=True)
class ClusterResult:
    enriched: DataFrame
    summary: DataFrame
    metrics: DataFrame | None
    k: int
    dictionary: DataFrame
    null_profile: DataFrame
    inf_profile: DataFrame
    matrix_audit: DataFrame
    model: fitted.FittedModel  # to be kept by ``fitted.save`` and applied by ``score_products``


def numbered(df: DataFrame) -> DataFrame:
    """Add a BIGINT ``row_id`` and write the table once, so that the id stays with its row."""
    return materialize(df.withColumn("row_id", F.monotonically_increasing_id()), "rows")


def with_parsed_text(df: DataFrame, columns) -> DataFrame:
    """Add the parsed form of the text columns that hold JSON or Python literals; plain text in them stays as it is."""
    strings = {c for c, t in df.dtypes if t == "string"}
    names = [c for c in columns if c in strings and spec.parsed(c) not in df.columns]
    found = embedded.json_columns(df, names) if names else []
    return df.withColumns({spec.parsed(c): F.coalesce(embedded.json_text(F.col(c)), F.col(c)) for c in found})


def fit_features(df: DataFrame, found: spec.FeatureSpec, options: ClusterOptions, encoder=None) -> tuple[fitted.FittedModel, DataFrame | None]:
    """The fitted blocks, without centres, and the names (position, term) of the text features."""
    model = fitted.FittedModel(weights=options.weights)
    if found.numeric:
        fit = features.fit_numeric(df, found.numeric)
        model = replace(model, numeric=fit if fit.columns else None)
    if found.categorical:
        model = replace(model, categories=features.fit_categories(df, found.categorical))
    if not found.text or options.text_mode == "none":
        return model, None
    texts = df.select("row_id", corpus([F.col(c).cast("string") for c in found.text]).alias("__text"))
    if options.text_mode == "encoder":
        first = features.encode_text(texts.limit(1), "__text", encoder, "v").first()
        names = [(i, f"embed_{i}") for i in range(len(first.v) if first else 0)]
        return replace(model, text=found.text, encoded=True), df.sparkSession.createDataFrame(names, "position int, term string")
    counts = materialize(tfidf.term_counts(texts, "row_id", "__text"), "counts")
    fit = tfidf.fit_tfidf(counts, texts.count(), options.min_df, options.max_features)
    size = fit.vocabulary.count()
    if not size:
        return model, None
    model = replace(model, text=found.text, vocabulary=fit)
    if not options.svd_dimensions or size <= options.svd_dimensions:
        return model, fit.vocabulary.select("position", "term")
    vectors = materialize(fit.model("grams", "txt_features").transform(tfidf.with_ngrams(texts, "__text")).select("row_id", "txt_features"), "terms")
    svd = project.fit_svd(vectors, options.svd_dimensions, "row_id", "txt_features")
    names = [(i, f"svd_{i}") for i in range(len(svd.singular_values))]
    return replace(model, svd=svd), df.sparkSession.createDataFrame(names, "position int, term string")


def feature_matrix(df: DataFrame, found: spec.FeatureSpec, options: ClusterOptions, encoder=None) -> tuple[fitted.FittedModel, DataFrame, DataFrame]:
    """The fitted model, (row_id, features) with the weighted blocks in one vector, and the feature dictionary."""
    model, terms = fit_features(df, found, options, encoder)
    rows, blocks = model.blocks(df, "row_id", encoder)
    matrix = materialize(features.assemble(materialize(rows, "blocks"), blocks, sizes=model.sizes()).select("row_id", "features"), "matrix")
    names = model.numeric.feature_names if model.numeric else []
    return model, matrix, features.feature_dictionary(names, model.categories, terms, df)


def prepared(raw: DataFrame, text_columns=spec.TEXT_COLUMNS) -> DataFrame:
    """Cleaned products with parsed text and a row id: what the model is fitted on, and what it scores."""
    return numbered(with_parsed_text(clean_products(raw), text_columns))


def score_products(model: fitted.FittedModel, raw: DataFrame, text_columns=spec.TEXT_COLUMNS, encoder=None) -> DataFrame:
    """Other products cleaned and placed by a kept model: all their columns, with cluster_id and cluster_dist."""
    ship_package(raw.sparkSession)
    df = prepared(raw, text_columns)
    placed = model.score(df, "row_id", encoder).select("row_id", "cluster_id", "cluster_dist")
    return relate.align(df, placed, ["row_id"])


def cluster_products(raw: DataFrame, options: ClusterOptions = ClusterOptions(), encoder=None) -> ClusterResult:
    """Clean, featurise, choose K, fit, diagnose and summarise a flat product table.

    Each stage that later ones read more than once is written to the shared work
    folder; nothing that grows with the data passes through the driver.
    """
    if options.k is not None and options.k < 2:
        raise ValueError("k must be at least 2")
    ship_package(raw.sparkSession)
    if options.sample:
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
        raw = summary.seeded_sample(raw, F.concat_ws("|", *keys), options.sample, options.seed)
    df = prepared(raw, options.text.split("|") if options.text else spec.TEXT_COLUMNS)
    found = spec.FeatureSpec.from_options(options.numeric, options.categorical, options.text, options.weights).resolve(df)
    checked = [*found.numeric, *found.categorical]
    numbers = df.select("row_id", *features.as_numbers(df, found.numeric))
    nulls, infinite = profile.null_profile(df, "row_id", checked), profile.inf_profile(numbers, "row_id")
    model, matrix, dictionary = feature_matrix(df, found, options, encoder)
    audit = materialize(audit_matrix(matrix, dictionary), "audit")
    if not audit.isEmpty():
        log.warning("the matrix has NaN or infinite entries: %s", [r.feature for r in audit.orderBy(F.col("n").desc(), "feature").limit(10).collect()])
    vectors = matrix.withColumn("vector", vector_to_array("features")).persist()
    try:
        metrics = None
        if options.k is not None:
            k = options.k
        else:
            metrics = materialize(
                kselect.sweep(matrix, *options.auto_k, "row_id", restarts=options.sweep_restarts, seed=options.seed, minibatch=options.minibatch), "metrics"
            )
            k = kselect.choose_k(metrics).first().chosen_k
        if options.minibatch:
            centers = cluster.fit_minibatch(vectors, k, "row_id", seed=options.seed, restarts=options.final_restarts)
        else:
            centers = cluster.fit_kmeans(vectors, k, restarts=options.final_restarts, seed=options.seed)
        enriched = diagnose(df, vectors, centers, options)
    finally:
        vectors.unpersist()
    table = summary.cluster_summary(_with(enriched, spec.MAX_PRICE_CHAIN[0], "double"))
    model = replace(model, centers=fitted.center_table(raw.sparkSession, centers))
    return ClusterResult(enriched, table, metrics, k, dictionary, nulls, infinite, audit, model)


def audit_matrix(matrix: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Features of the matrix with the most NaN and infinite entries; names come in after the count."""
    worst = profile.nonfinite_features(nonfinite_entries(matrix, "row_id"), "row_id", "position", "value")
    return worst.join(dictionary.select("position", "feature"), "position").drop("position")


def _with(df: DataFrame, column: str, kind: str) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def diagnose(df: DataFrame, vectors: DataFrame, centers: np.ndarray, options: ClusterOptions) -> DataFrame:
    """Cluster, distance, outlier flag, neighbours, label, price band and projection beside the rows."""
    spark = df.sparkSession
    assigned = vectors.withColumn("cluster_id", cluster.nearest_center(centers)("vector"))
    placed = materialize(cluster.centroid_distance(assigned, fitted.center_table(spark, centers)), "placed")
    flagged = summary.outlier_flag(placed, approximate=options.approximate_cuts)
    result = relate.align(df, flagged.select("row_id", "cluster_id", "cluster_dist", "cluster_outlier"), ["row_id"])
    if options.neighbors:
        ids = df.select("row_id", spec.item_id(df).alias("__item"))
        search = placed.select("row_id", "cluster_id", "vector").join(ids, "row_id")
        near = neighbors.nearest_in_cluster(
            search, "row_id", "cluster_id", "vector", options.neighbors, item="__item", distinct_item=options.distinct_item
        )
        result = neighbors.widen(result, near, "row_id", options.neighbors)
    if options.projection:
        result = relate.align(result, project.project_2d(vectors, "row_id"), ["row_id"])
    result = materialize(result, "diagnosed")
    result = relate.attach_label(result, summary.group_labels(result))
    return add_price_band(result)


def write_outputs(result: ClusterResult, output: str, metrics_out: str | None = None, summary_out: str | None = None, neighbors_kept: int = 3) -> None:
    """Enriched table, and the metric and summary tables where a path is given."""
    write_enriched(result.enriched, output, neighbors_kept)
    if result.metrics is not None:
        write_if_wanted(result.metrics, metrics_out)
    write_if_wanted(result.summary, summary_out)
