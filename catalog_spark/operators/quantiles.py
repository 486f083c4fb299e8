"""Exact quantiles, modes and first values per group, in bounded memory.

The built-in ``percentile``, ``median`` and ``mode`` keep one value-to-count map
per group in a single task.  Here a hot group is spread over its values instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .skew import lookup_join

OCTAVE_BINS = 16  # first round: bins for each doubling of the magnitude, some 67,000 over all numbers
BINS = 4096  # later rounds: bins between the least and the greatest value that are left
SMALL = 4096  # as few values of a group are sorted at once


def _first_bin(x: Column) -> Column:
    """A whole number that never falls while ``x`` rises: by sign and magnitude."""
    size = F.floor(F.log2(F.abs(x)) * OCTAVE_BINS) + 1100 * OCTAVE_BINS  # above 0 for the smallest number
    most = F.lit(3000 * OCTAVE_BINS).cast("long")
    return F.when(x == 0, F.lit(0).cast("long")).when(x == float("inf"), most).when(x == float("-inf"), -most).when(x > 0, size).otherwise(-size)


def _later_bin(x: Column) -> Column:
    """The same between ``lo`` and ``hi``, numbers of like size that get different bins however close they are."""
    return F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)


def _descend(counts: DataFrame, cell: list[str], rank: Column) -> DataFrame:
    """The bin of each cell that holds its rank, with the rank inside it; a cell has a bounded number of bins."""
    upto = Window.partitionBy(*cell).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counts.withColumn("upto", F.sum("n").over(upto))
    return counted.where((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)).withColumn("rank", rank - (F.col("upto") - F.col("n")))


def group_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    prob: float,
    name: str = "quantile",
    approximate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per group with the linearly interpolated quantile of ``value``.

    Selection by rounds.  The values of a group are counted by bins of their magnitude, map-side first; the bin that holds
    the wanted rank is cut into finer bins, and so on, until all its values are equal or so few that one task sorts
    them.  No task sees more than the bins of a group or ``SMALL`` of its values, and the answer is exact whatever the
    values.  Null, NaN and text that is no number are not counted; a group without values has no row.
    ``approximate=True`` gives a sketch's answer instead.
    """
    keys = list(keys)
    group = [f"__g{i}" for i in range(len(keys))] or ["__g"]
    x = df.select(*[F.col(k).alias(g) for k, g in zip(keys, group)], F.col(value).try_cast("double").alias("x"))
    if not keys:
        x = x.withColumn("__g", F.lit(1))
    x = x.where(F.col("x").isNotNull() & ~F.isnan("x"))
    named = [F.col(g).alias(k) for k, g in zip(keys, group)]
    if approximate:
        return x.groupBy(*group).agg(F.approx_percentile("x", prob, accuracy).alias(name)).select(*named, name)

    statistics = [F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")]
    x = x.withColumn("bin", _first_bin(F.col("x")))
    counts = materialize(x.groupBy(*group, "bin").agg(*statistics), "bins")
    counts = counts.withColumn("position", F.lit(prob) * (F.sum("n").over(Window.partitionBy(*group)) - 1))
    # the two neighbours between which the quantile lies, searched for on their own
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), r.cast("long").alias("at")) for i, r in enumerate((F.floor("position"), F.ceil("position")))]))
    cell = [*group, "side"]
    wanted = counts.select("*", sides.alias("s")).select(*counts.columns, "s.side", "s.at")
    found = materialize(_descend(wanted, cell, F.col("at")).select(*cell, "bin", "n", "lo", "hi", "rank", "position"), "ranks")
    done = [found.where("lo = hi").select(*cell, F.col("lo").alias("value"), "position")]
    open_cells = found.where("lo <> hi")

    # the values of the bins that are cut further
    by_bin = open_cells.groupBy(*group, "bin").agg(F.collect_list(F.struct("side", "n", "lo", "hi", "rank", "position")).alias("cells"))  # at most two
    left = lookup_join(x, by_bin, [*group, "bin"])
    left = left.select(*group, "x", F.inline("cells"))
    carried = [*cell, "n", "lo", "hi", "rank", "position"]
    sizes = open_cells.agg(F.max("n")).first()[0]
    while sizes:
        left = left.select("x", *carried)
        if sizes > SMALL:
            left = materialize(left, "left")
        few = left.where(F.col("n") <= SMALL).groupBy(*cell)
        done.append(few.agg(F.get(F.sort_array(F.collect_list("x")), F.first("rank").cast("int")).alias("value"), F.first("position").alias("position")))
        if sizes <= SMALL:
            break
        many = left.where(F.col("n") > SMALL).withColumn("bin", _later_bin(F.col("x")))
        counts = many.groupBy(*cell, "bin").agg(*statistics, F.first("rank").alias("at"), F.first("position").alias("position"))
        found = materialize(_descend(counts, cell, F.col("at")).select(*cell, "bin", "n", "lo", "hi", "rank", "position"), "ranks")
        done.append(found.where("lo = hi").select(*cell, F.col("lo").alias("value"), "position"))
        open_cells = found.where("lo <> hi")
        left = lookup_join(many.select(*cell, "x", "bin"), open_cells, [*cell, "bin"], written=True)
        sizes = open_cells.agg(F.max("n")).first()[0]

    sides = done[0]
    for more in done[1:]:
        sides = sides.unionByName(more)
    both = sides.groupBy(*group).agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("low"), F.max(F.when(F.col("side") == 1, F.col("value"))).alias("high"), F.first("position").alias("position")
    )
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("position") - F.floor("position"))
    # Equal neighbours need no arithmetic, which also keeps infinities intact.
    return both.select(*named, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias(name))


def group_median(df: DataFrame, keys: list[str], value: str, name: str = "median", approximate: bool = False) -> DataFrame:
    return group_quantile(df, keys, value, 0.5, name, approximate)


def group_mode(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, the smallest one on ties, NULL if there is none.

    Counting per (group, value) first lets a hot group spread over its values.
    """
    counts = df.groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    order = F.struct(F.col("__v").isNull(), -F.col("__c"), F.col("__v"))
    return counts.groupBy(*keys).agg(F.min_by("__v", order).alias(name))
