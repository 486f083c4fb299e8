"""Fitted feature blocks and centres as one model that can be kept, read back and applied to other rows."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import corpus
from . import cluster, features, tfidf
from .project import Svd

VERSION = "version"  # name of the folders of a saved model, one for each time it was saved


@dataclass(frozen=True)
class FittedModel:
    """Blocks that were fitted together, their weights, and the centres if there are any.

    A block that was not fitted is None and gives no features.  ``centers`` is a table (cluster_id, center) of any length.
    """

    numeric: features.NumericScaler | None = None
    categories: features.CategoryEncoder | None = None
    text: tuple[str, ...] = ()
    vocabulary: tfidf.TfIdf | None = None
    svd: Svd | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    centers: DataFrame | None = None
    encoded: bool = False  # the text block came from an encoder, which the caller has to give again

    def columns(self) -> dict[str, str]:
        """The columns that are read, and the type that one which is not there is taken to have."""
        numbers = dict.fromkeys(self.numeric.columns if self.numeric else (), "double")
        return numbers | dict.fromkeys([*(self.categories.columns if self.categories else ()), *self.text], "string")

    def blocks(self, df: DataFrame, row_id: str, encoder=None) -> tuple[DataFrame, list[tuple[str, float]]]:
        """(row_id, a column a block), and the blocks' names and weights.  Columns that ``df`` lacks count as null."""
        lacking = {c: F.lit(None).cast(kind) for c, kind in self.columns().items() if c not in df.columns}
        rows, found = df.withColumns(lacking) if lacking else df, []
        rows = rows.select(row_id, *[c for c in self.columns() if c != row_id])
        if self.text and (self.vocabulary is not None or self.encoded):
            rows = rows.withColumn("__text", corpus([F.col(c).cast("string") for c in self.text]))
        if self.numeric and self.numeric.columns:
            rows = rows.withColumn("num_features", F.array(*self.numeric.expressions(rows)))
            found.append(("num_features", self.weights[0]))
        if self.categories is not None:
            rows = self.categories.transform(rows, "cat_features")
            found.append(("cat_features", self.weights[1]))
        if "__text" in rows.columns:
            if self.encoded:
                if encoder is None:
                    raise ValueError("the text block was made by an encoder: give it again")
                rows = features.encode_text(rows, "__text", encoder, "txt_features")
            else:
                rows = self.vocabulary.model("grams", "txt_features").transform(tfidf.with_ngrams(rows, "__text"))
            found.append(("txt_features", self.weights[2]))
        rows = rows.select(row_id, *[name for name, _ in found])
        if self.svd is not None:
            rows = self.reduced(rows)
        return rows, found

    def reduced(self, rows: DataFrame) -> DataFrame:
        """The text block in the fitted directions; the other blocks pass by, so nothing is joined."""
        packed = rows.select(F.struct(*[c for c in rows.columns if c != "txt_features"]).alias("__kept"), "txt_features")
        short = self.svd.transform(packed, "__kept", "txt_features", "__short")
        return short.select("__kept.*", F.col("__short").alias("txt_features"))

    def sizes(self) -> dict[str, int] | None:
        """Features of each block; None if they are up to an encoder."""
        if self.encoded:
            return None
        text = len(self.svd.singular_values) if self.svd is not None else self.vocabulary.vocabulary.count() if self.vocabulary is not None else 0
        levels = self.categories.feature_table().count() if self.categories is not None else 0
        return {"num_features": len(self.numeric.columns) if self.numeric else 0, "cat_features": levels, "txt_features": text}

    def vectors(self, df: DataFrame, row_id: str, encoder=None) -> DataFrame:
        """(row_id, features): one row for each row of ``df``, repeated ids included."""
        rows, found = self.blocks(df, row_id, encoder)
        return features.assemble(rows, found, sizes=self.sizes()).select(row_id, "features")

    def score(self, df: DataFrame, row_id: str, encoder=None) -> DataFrame:
        """(row_id, features, cluster_id, cluster_dist) by the nearest centre."""
        if self.centers is None:
            raise ValueError("the model has no centres")
        rows = self.vectors(df, row_id, encoder).withColumn("__vector", vector_to_array("features"))
        placed = cluster.assign_nearest(rows, self.centers, "__vector")
        return cluster.centroid_distance(placed, self.centers, "cluster_id", "__vector").select(row_id, "features", "cluster_id", "cluster_dist")


def center_table(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "cluster_id int, center array<double>")


# ------------------------------------------------------------------- kept models


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under ``path``, oldest first."""
    try:
        found = spark.read.schema(f"{VERSION} int, settings string").json(f"{path}/settings")
    except AnalysisException:  # nothing saved yet
        return []
    return sorted(r[0] for r in found.select(VERSION).distinct().collect())


def save(model: FittedModel, path: str, spark: SparkSession) -> int:
    """Write ``model`` as the next version under ``path``; its number.

    Every part is a table.  The settings are written last and a version without them does not count, so a save that was
    cut off leaves the versions before it as they were.  One writer at a time.
    """
    number = max(versions(spark, path), default=0) + 1
    folder = f"{path}/{VERSION}={number}"
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}")
    if model.numeric is not None:
        rows = [(i, *r) for i, r in enumerate(zip(model.numeric.columns, model.numeric.medians, model.numeric.divisors))]
        write(spark.createDataFrame(rows, "position int, name string, median double, divisor double"), "numeric")
    if model.categories is not None:
        write(model.categories.levels, "levels")
    if model.vocabulary is not None:
        write(model.vocabulary.vocabulary, "vocabulary")
    if model.svd is not None:
        rows = [(i, float(s), [float(x) for x in c]) for i, (s, c) in enumerate(zip(model.svd.singular_values, model.svd.components.T))]
        write(spark.createDataFrame(rows, "position int, value double, component array<double>"), "svd")
    if model.centers is not None:
        write(model.centers, "centers")
    settings = {
        "parts": [n for n in ("numeric", "categories", "vocabulary", "svd", "centers") if getattr(model, n) is not None],
        "categorical": list(model.categories.columns) if model.categories is not None else [],
        "text": list(model.text), "weights": list(model.weights), "encoded": model.encoded,
        "documents": model.vocabulary.documents if model.vocabulary is not None else 0,
    }
    done = spark.createDataFrame([(number, json.dumps(settings))], f"{VERSION} int, settings string")
    done.coalesce(1).write.mode("append").json(f"{path}/settings")
    return number


def load(spark: SparkSession, path: str, version: int | None = None) -> FittedModel:
    """The given complete version, the latest by default."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no complete version {'' if version is None else f'{version} '}under {path}")
    version = known[-1] if version is None else version
    lines = spark.read.schema(f"{VERSION} int, settings string").json(f"{path}/settings")
    settings = json.loads(lines.where(F.col(VERSION) == version).first().settings)
    parts = settings["parts"]
    read = lambda name: spark.read.parquet(f"{path}/{VERSION}={version}/{name}")
    model = FittedModel(text=tuple(settings["text"]), weights=tuple(settings["weights"]), encoded=settings["encoded"])
    if "numeric" in parts:
        rows = read("numeric").orderBy("position").collect()  # one row a column
        model = replace(model, numeric=features.NumericScaler(*(tuple(r[i] for r in rows) for i in (1, 2, 3))))
    if "categories" in parts:
        model = replace(model, categories=features.CategoryEncoder(tuple(settings["categorical"]), read("levels")))
    if "vocabulary" in parts:
        model = replace(model, vocabulary=tfidf.TfIdf(read("vocabulary"), settings["documents"]))
    if "svd" in parts:
        rows = read("svd").orderBy("position").collect()  # one row a component
        model = replace(model, svd=Svd(np.array([r.component for r in rows]).T, np.array([r.value for r in rows])))
    return replace(model, centers=read("centers")) if "centers" in parts else model
