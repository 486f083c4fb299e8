"""Numeric and categorical feature blocks, their assembly and the feature dictionary."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.clean import numeric
from ..functions.vectors import as_double, scale
from ..session import materialize
from .quantiles import group_median
from .skew import lookup_join
from .summary import rank_rows

NULL_LEVEL = "__null__"
RARE_LEVEL = "__infrequent__"


def as_numbers(df: DataFrame, columns) -> list:
    kinds = dict(df.dtypes)
    return [numeric(F.col(c), kinds[c] in ("string", "variant")).alias(c) for c in columns]


# ---------------------------------------------------------------- numeric block


@dataclass(frozen=True)
class NumericScaler:
    """Median imputation, then division by the population standard deviation (no centering)."""

    columns: tuple[str, ...]
    medians: tuple[float, ...]
    divisors: tuple[float, ...]

    @property
    def feature_names(self) -> list[str]:
        return [f"num__{c}" for c in self.columns]

    def expressions(self, df: DataFrame) -> list:
        values = as_numbers(df, self.columns)
        return [
            (F.coalesce(v, F.lit(m)) / F.lit(d)).alias(f"num__{c}")
            for v, c, m, d in zip(values, self.columns, self.medians, self.divisors)
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        """The scaled columns beside the others."""
        return df.select("*", *self.expressions(df))

    def long(self, df: DataFrame, row_id: str) -> DataFrame:
        """(row_id, feature, value)."""
        wide = df.select(row_id, *self.expressions(df))
        return unpivot(wide, row_id, self.feature_names)


def unpivot(df: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    return df.unpivot([row_id], columns, "feature", "value")


def fit_numeric(df: DataFrame, columns) -> NumericScaler:
    """Medians over all columns in one pass, deviations in another; all-null columns are left out, infinities refused.

    The driver sees two numbers per column.
    """
    numbers = df.select(*as_numbers(df, columns))
    endless = numbers.agg(*[F.count_if(F.abs(c) == float("inf")).alias(c) for c in columns]).first().asDict() if columns else {}
    if any(endless.values()):
        raise ValueError(f"infinite values in {sorted(c for c, n in endless.items() if n)}; remove them before the fit")
    long = numbers.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])))
    medians = {r.feature: r["median"] for r in group_median(long, ["feature"], "value").collect()}
    kept = [c for c in columns if c in medians]
    if not kept:
        return NumericScaler((), (), ())
    filled = numbers.select(*[F.coalesce(F.col(c), F.lit(medians[c])).alias(c) for c in kept])
    stats = filled.agg(
        F.count("*").alias("n"),
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(kept)],
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(kept)],
    ).first()
    eps = sys.float_info.epsilon
    divisors = []
    for i in range(len(kept)):
        var, mean, n = stats[f"v{i}"], stats[f"m{i}"], stats["n"]
        constant = var <= n * eps * var + (n * mean * eps) ** 2  # no more than rounding error
        divisors.append(1.0 if constant else var**0.5)
    return NumericScaler(tuple(kept), tuple(medians[c] for c in kept), tuple(divisors))


# ------------------------------------------------------------ categorical block


def category_rows(df: DataFrame, row_id: str | None, columns) -> DataFrame:
    """(row_id, column_name, level), NULL as a level of its own."""
    keep = [row_id] if row_id else []
    levels = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL)) for c in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), v.alias("level")) for c, v in zip(columns, levels)])
    return df.select(*keep, F.inline(pairs))


def category_counts(df: DataFrame, columns, min_frequency: int = 5) -> DataFrame:
    """(column_name, level, n, pooled): how often each level occurs and the level it is encoded as."""
    counts = category_rows(df, None, columns).groupBy("column_name", "level").agg(F.count("*").alias("n"))
    return counts.withColumn("pooled", F.when(F.col("n") >= min_frequency, F.col("level")).otherwise(RARE_LEVEL))


@dataclass(frozen=True)
class CategoryEncoder:
    """One-hot levels per column: frequent ones, one pool for the rest, nothing for unseen ones.

    ``levels`` is a written table (column_name, level, n, pooled, position).
    """

    columns: tuple[str, ...]
    levels: DataFrame

    def feature_table(self) -> DataFrame:
        """(column_name, pooled, position): one row per feature."""
        return self.levels.select("column_name", "pooled", "position").distinct()

    def long(self, df: DataFrame, row_id: str) -> DataFrame:
        """(row_id, feature, value) with value 1.0 for the level of each row."""
        rows = category_rows(df, row_id, self.columns)
        lookup = self.levels.select("column_name", "level", "pooled")
        feature = F.concat(F.lit("cat__"), "column_name", F.lit("_"), "pooled")
        return lookup_join(rows, lookup, ["column_name", "level"], written=True).select(
            row_id, feature.alias("feature"), F.lit(1.0).alias("value")
        )

    def transform(self, df: DataFrame, output: str = "cat_features") -> DataFrame:
        """Sparse vector column; unseen levels give zeros."""
        sizes = {r.column_name: r.size for r in self.feature_table().groupBy("column_name").agg(F.count("*").alias("size")).collect()}
        indexed, index_names, hot_names = df, [], []
        for i, c in enumerate(self.columns):
            lookup = self.levels.where(F.col("column_name") == c).select(
                F.col("level").alias("__level"), F.col("position").cast("double").alias(f"__pos{i}")
            )
            indexed = indexed.withColumn("__level", F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL)))
            indexed = lookup_join(indexed, lookup, ["__level"], "left", written=True).drop("__level")
            indexed = indexed.withColumn(f"__pos{i}", F.coalesce(f"__pos{i}", F.lit(float(sizes[c]))))
            index_names.append(f"__pos{i}")
            hot_names.append(f"__hot{i}")
        spark = df.sparkSession
        # The encoder learns its sizes from one row that holds the last position of each column.
        top = spark.createDataFrame([tuple(float(sizes[c] - 1) for c in self.columns)], index_names)
        encoder = OneHotEncoder(inputCols=index_names, outputCols=hot_names, handleInvalid="keep", dropLast=True).fit(top)
        encoded = encoder.transform(indexed)
        assembled = VectorAssembler(inputCols=hot_names, outputCol=output).transform(encoded)
        return assembled.drop(*index_names, *hot_names)


def fit_categories(df: DataFrame, columns, min_frequency: int = 5) -> CategoryEncoder:
    counts = category_counts(df, columns, min_frequency)
    counts = materialize(counts, "counts")
    features = counts.select("column_name", "pooled").distinct()
    # Levels may be many, so they are numbered over all columns at once and in parallel.
    numbered = rank_rows(features, [F.col("column_name"), F.col("pooled") == RARE_LEVEL, F.col("pooled")], "__rank")
    starts = numbered.groupBy("column_name").agg(F.min("__rank").alias("__start"))
    positions = numbered.join(F.broadcast(starts), "column_name")  # one row per column
    positions = positions.select("column_name", "pooled", (F.col("__rank") - F.col("__start")).cast("int").alias("position"))
    # The rare level repeats for every rare value, the others occur once.
    common = counts.where(F.col("pooled") != RARE_LEVEL).join(positions, ["column_name", "pooled"])
    rare_position = positions.where(F.col("pooled") == RARE_LEVEL)  # one row per column at most
    rare = counts.where(F.col("pooled") == RARE_LEVEL).join(F.broadcast(rare_position), ["column_name", "pooled"])
    levels = common.unionByName(rare).select("column_name", "level", "n", "pooled", "position")
    return CategoryEncoder(tuple(columns), materialize(levels, "levels"))


# --------------------------------------------------------------------- assembly


def weighted_long(blocks: list[tuple[DataFrame | None, float]]) -> DataFrame:
    """Long-form blocks, each scaled by its weight, one below the other."""
    kept = [b.withColumn("value", F.col("value") * F.lit(float(w))) for b, w in blocks if b is not None]
    if not kept:
        raise ValueError("no feature block: check the column lists and the input")
    return reduce(DataFrame.unionByName, kept)


def assemble(df: DataFrame, blocks: list[tuple[str, float]], output: str = "features", sizes: dict[str, int] | None = None) -> DataFrame:
    """Vector columns (or ARRAY<DOUBLE> columns), each scaled by its weight, as one vector.

    Without the ``sizes`` of the blocks a first row has to be there to tell them.
    """
    from pyspark.ml.feature import ElementwiseProduct, VectorSizeHint
    from pyspark.ml.linalg import DenseVector, VectorUDT

    kinds = {f.name: f.dataType for f in df.schema.fields}
    inputs, scratch = [], []
    for i, (name, weight) in enumerate(blocks):
        out = f"__block{i}"
        if isinstance(kinds[name], VectorUDT):
            if weight == 1.0:
                inputs.append(name)
                continue
            size = sizes[name] if sizes else vector_size(df, name)
            df = ElementwiseProduct(inputCol=name, outputCol=out, scalingVec=DenseVector([weight] * size)).transform(df)
        else:
            df = df.withColumn(out, array_to_vector(scale(as_double(F.col(name)), weight)))
        inputs.append(out)
        scratch.append(out)
    if not inputs:
        raise ValueError("no feature block: check the column lists and the input")
    if sizes:
        for column, (name, _) in zip(inputs, blocks):
            df = VectorSizeHint(inputCol=column, size=sizes[name], handleInvalid="error").transform(df)
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error").transform(df).drop(*scratch)


def vector_size(df: DataFrame, column: str) -> int:
    first = df.select(column).first()
    return 0 if first is None else first[0].size


def feature_dictionary(num_names: list[str], categories: CategoryEncoder | None, text_terms: DataFrame | None, df: DataFrame) -> DataFrame:
    """(position, feature, block) for the columns of the assembled matrix.

    Built after all-null columns were dropped, so names and columns always agree.
    ``text_terms`` has (position, term).
    """
    spark = df.sparkSession
    parts = []
    if num_names:
        parts.append(spark.createDataFrame([("1num", 0, i, n) for i, n in enumerate(num_names)], "block string, c int, p int, feature string"))
    if categories is not None:
        at = F.element_at(F.create_map(*[x for i, c in enumerate(categories.columns) for x in (F.lit(c), F.lit(i))]), F.col("column_name"))
        parts.append(
            categories.feature_table().select(
                F.lit("2cat").alias("block"), at.alias("c"), F.col("position").alias("p"),
                F.concat(F.lit("cat__"), "column_name", F.lit("_"), "pooled").alias("feature"),
            )
        )
    if text_terms is not None:
        parts.append(
            text_terms.select(F.lit("3txt").alias("block"), F.lit(0).alias("c"), F.col("position").alias("p"), F.concat(F.lit("txt__"), "term").alias("feature"))
        )
    names = reduce(DataFrame.unionByName, parts)
    ranked = rank_rows(names, [F.col("block"), F.col("c"), F.col("p")], "__rank")
    return ranked.select((F.col("__rank") - 1).cast("int").alias("position"), "feature", F.substring("block", 2, 3).alias("block"))


# ------------------------------------------------------------------- embeddings


def join_embeddings(df: DataFrame, vectors: DataFrame, row_id: str, vector: str = "embedding") -> DataFrame:
    """Precomputed embeddings onto their rows; a row without one keeps NULL there (see ``missing_embeddings``)."""
    return df.join(vectors.select(row_id, as_double(F.col(vector)).alias(vector)), row_id, "left")


def missing_embeddings(df: DataFrame, vector: str = "embedding") -> int:
    """Rows that have no embedding."""
    return df.where(F.col(vector).isNull()).count()


def encode_text(df: DataFrame, text: str, encoder, output: str = "embedding", batch: int = 256) -> DataFrame:
    """Embeddings from any ``encoder(list of str) -> 2-D array``, called with ``batch`` texts at a time."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(series: pd.Series) -> pd.Series:
        texts = series.fillna("").tolist()
        out = []
        for start in range(0, len(texts), batch):
            out.extend([float(x) for x in row] for row in encoder(texts[start : start + batch]))
        return pd.Series(out)

    return df.withColumn(output, encode(F.col(text)))


