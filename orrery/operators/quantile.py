"""Exact medians and ranks per group without gathering a group's values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.plans.staging import staged

#: Bins into which the range of a group is divided in each round.
BINS = 1024
#: Different values of a group in whose midst a median is then found by sorting.
FEW = 10_000
#: Groups up to which their ranges are broadcast.
MAX_GROUPS = 100_000


def exact_medians(df: DataFrame, by: list[str], value: str, few: int = FEW) -> DataFrame:
    """(*by, median, n) over the values of each group that are not null."""
    # Two middle ranks where n is even.
    found = _ranked(df, by, value, lambda n: F.array(F.floor((n - 1) / 2), F.floor(n / 2)), F.lit(1), few)
    return found.groupBy("g").agg(F.avg("v").alias("median"), F.max("n").alias("n")).select("g.*", "median", "n")


def exact_values(
    df: DataFrame, by: list[str], value: str, places: Callable[[Column], Column], weight: Column | None = None, few: int = FEW
) -> DataFrame:
    """(*by, place, value, n): the values of each group, nulls left out, at ``places``.

    ``places`` gives an array of ranks, from 0, for the number of values ``n``. A row
    counts ``weight`` times, a whole number of 1 or more.
    """
    found = _ranked(df, by, value, places, F.lit(1) if weight is None else weight, few)
    return found.select("g.*", "place", F.col("v").alias("value"), "n")


def _ranked(df: DataFrame, by: list[str], value: str, places: Callable[[Column], Column], weight: Column, few: int) -> DataFrame:
    """(g, place, v, n).

    Equal values are counted first, before any shuffle. Then the range around each
    rank is narrowed by histograms, all groups at once, until it holds few values; so
    neither a group nor the table is ever in one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.struct(*by).alias("g"), F.col(value).alias("v"))
    counts = staged(counts.agg(F.sum(weight).alias("c")), "value-counts")
    ends = counts.groupBy("g").agg(
        F.sum("c").alias("n"), F.count("*").alias("width"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    # ``rank`` counts on from the range's start.
    each = F.explode(F.array_distinct(places(F.col("n"))))
    want = staged(ends.select("*", each.alias("place")).withColumn("rank", F.col("place")), "ranges")
    while (want.agg(F.max("width")).first()[0] or 0) > few:
        lo, hi = F.col("lo"), F.col("hi")
        # Halved, so that no range overflows.
        step = (hi / 2 - lo / 2) / BINS
        b = F.when(hi > lo, F.least(F.lit(BINS - 1), F.floor((F.col("v") / 2 - lo / 2) / step))).otherwise(0)
        bins = _inside(counts, want).groupBy("g", "n", "place", "rank", b.alias("b")).agg(
            F.sum("c").alias("c"), F.count("*").alias("width"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        want = staged(_holding(bins, "b").select("g", "n", "width", "lo", "hi", "place", "rank"), "ranges")
    return _holding(_inside(counts, want), "v").select("g", "place", "v", "n")


def _inside(counts: DataFrame, want: DataFrame) -> DataFrame:
    few = F.broadcast(want) if want.count() <= MAX_GROUPS else want
    return counts.join(few, "g").where(F.col("v").between(F.col("lo"), F.col("hi")))


def _holding(parts: DataFrame, order: str) -> DataFrame:
    """The part of each range that holds its rank, which then counts from that part's start."""
    before = F.sum("c").over(Window.partitionBy("g", "place").orderBy(order)) - F.col("c")
    at = parts.withColumn("rank", F.col("rank") - before)
    return at.where((F.col("rank") >= 0) & (F.col("rank") < F.col("c")))
