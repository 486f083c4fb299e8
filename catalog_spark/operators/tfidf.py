"""TF-IDF over uni- and bigrams."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import bigrams, fold_accents, tokens, words
from ..session import materialize, release
from . import grouped as by_group
from .grouped import GroupedCounts
from .skew import BROADCAST_ROWS
from .summary import rank_rows

# Fixed value: least document frequency used when none is given.
MIN_DF = 3
TASK_BYTES = 8 << 20  # of texts whose terms a task counts


def with_ngrams(df: DataFrame, text: str, output: str = "grams") -> DataFrame:
    """Words followed by pairs of neighbouring words."""
    cut = df.withColumn("__w", tokens(F.col(text)))
    return cut.withColumn(output, F.concat("__w", bigrams(F.col("__w")))).drop("__w")


def text_bytes(df: DataFrame, text: str) -> int:
    """Size of all texts of a column."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def term_counts(df: DataFrame, row_id: str, text: str, size: int | None = None, grouped: bool = False) -> DataFrame | GroupedCounts:
    """(row_id, term, tf).

    The texts are shuffled by row id after the Python step and before they are cut
    up; counting then needs no shuffle of the far larger number of terms.  A task gets
    texts of ``TASK_BYTES``, as their counts are held at once; ``size`` is that of all
    texts, which is read from ``df`` unless given.

    ``grouped`` is for large tables that a vocabulary is fitted on and whose weights are wanted: the counts are
    worked out in groups of texts when needed, and neither written nor shuffled row by row.
    """
    size = text_bytes(df, text) if size is None else size
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    folded = df.select(row_id, F.lower(text).alias("__l")).select(row_id, fold_accents(F.col("__l")).alias("__t"))
    if grouped:
        folded = folded.select(F.pmod(F.xxhash64(row_id), F.lit(tasks)).cast("int").alias("__group"), row_id, "__t")
        folded = folded.repartition(tasks, "__group").sortWithinPartitions("__group")  # by which words would take longer to sort
        return GroupedCounts(folded.select("__group", row_id, words(F.col("__t")).alias("__words")), row_id, tasks, max(1, tasks // 2))
    folded = folded.repartition(tasks, row_id)
    grams = folded.select(row_id, words(F.col("__t")).alias("__w"))
    grams = grams.select(row_id, F.concat("__w", bigrams(F.col("__w"))).alias("__g"))
    # The outer form keeps Spark from computing the n-grams once more to filter empty ones.
    terms = grams.select(row_id, F.explode_outer("__g").alias("term")).where(F.col("term").isNotNull())
    return terms.groupBy(row_id, "term").agg(F.count("*").alias("tf"))


@dataclass(frozen=True)
class TfIdf:
    """Vocabulary table (position, term, df, idf), and the fitted rows' number.

    One fitted on grouped counts knows them, and what each group has to know of the vocabulary.
    """

    vocabulary: DataFrame
    documents: int
    counts: GroupedCounts | None = None
    answers: DataFrame | None = None

    def terms(self) -> list[str]:
        return [r.term for r in self.vocabulary.orderBy("position").collect()]

    def long(self, counts: DataFrame | GroupedCounts, row_id: str, terms: bool = True) -> DataFrame:
        """(row_id, term, position, weight): tf x idf, rows scaled to unit length; without the term's text unless ``terms``.

        The window per row holds the terms of one text.  Grouped counts are those of the fit, or a share of them.
        """
        columns = [row_id, *(["term"] if terms else []), "position", "weight"]
        if isinstance(counts, GroupedCounts):
            if (counts.whole or counts) is not self.counts:
                raise ValueError("grouped counts can only be weighed by the fit on them")
            return by_group.weights(counts, self.answers, self.documents, terms).select(*columns)
        raw = self.join(counts).withColumn("__w", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(row_id)))
        return raw.withColumn("weight", F.col("__w") / norm).select(*columns)

    def join(self, rows: DataFrame) -> DataFrame:
        """The rows of known terms beside their vocabulary entries, by term or else by position.

        A vocabulary goes to the driver and the tasks only up to ``BROADCAST_ROWS`` terms: the size of its files says little
        about its size in memory.
        """
        few = self.vocabulary.count() <= BROADCAST_ROWS
        return rows.join(self.vocabulary.hint("broadcast" if few else "merge"), "term" if "term" in rows.columns else "position")

    def model(self, grams: str = "grams", output: str = "txt_features") -> PipelineModel:
        """The same weights as a saveable pipeline over a column of n-grams (sparse vectors, no shuffle)."""
        rows = self.vocabulary.orderBy("position").collect()
        count = CountVectorizerModel.from_vocabulary([r.term for r in rows], inputCol=grams, outputCol=f"__{output}_tf")
        weigh = ElementwiseProduct(inputCol=f"__{output}_tf", outputCol=f"__{output}_w", scalingVec=DenseVector([r.idf for r in rows]))
        unit = Normalizer(inputCol=f"__{output}_w", outputCol=output, p=2.0)
        return PipelineModel([count, weigh, unit])


def document_threshold(min_df: int | float, documents: int) -> int:
    """An int is a number of documents, a float a share of them."""
    if isinstance(min_df, bool) or min_df < 0 or (isinstance(min_df, float) and min_df > 1):
        raise ValueError("min_df must be a count (int) or a share between 0 and 1 (float)")
    return math.ceil(min_df * documents) if isinstance(min_df, float) else min_df


def fit_tfidf(counts: DataFrame | GroupedCounts, documents: int, min_df: int | float = MIN_DF, max_features: int | None = None) -> TfIdf:
    """Keep terms in enough documents, in term order; with ``max_features``, the most frequent of them (ties by term).

    The vector form needs a width, which the caller states; the long form needs none.
    """
    least = document_threshold(min_df, documents)
    if isinstance(counts, GroupedCounts):
        found, drop = by_group.count_parts(counts, least)
        kept, place = found.where("term IS NOT NULL"), ["part", "number"]
    else:
        kept, place = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= least), []
    if max_features is not None:
        kept = kept.orderBy(F.col("total").desc(), "term").limit(max_features)
    idf = F.ln(F.lit(1.0 + documents) / (F.col("df") + 1)) + 1.0
    numbered = rank_rows(kept.select("term", "df", idf.alias("idf"), *place), [F.col("term")], "position")
    vocabulary = materialize(numbered.select((F.col("position") - 1).cast("int").alias("position"), "term", "df", "idf", *place), "vocabulary")
    if not place:
        return TfIdf(vocabulary, documents)
    answers = by_group.answers(found, vocabulary)
    drop()
    release(vocabulary.sparkSession)
    return TfIdf(vocabulary.drop(*place), documents, counts, answers)
