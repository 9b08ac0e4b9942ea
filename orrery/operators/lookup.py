"""Queries over a finished table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_COLUMNS = ["designation", "name", "provisional_designation"]


def lookup(df: DataFrame, query: str) -> DataFrame:
    """Rows whose names hold ``query`` literally, whatever the case; a blank query
    and a missing name match nothing."""
    q = query.strip().upper()
    hit = F.lit(False)
    for c in TEXT_COLUMNS:
        if q and c in df.columns:
            hit |= F.coalesce(F.contains(F.upper(F.col(c).cast("string")), F.lit(q)), F.lit(False))
    return df.where(hit)


def in_region(df: DataFrame, lo: float, hi: float, axis: str = "semi_major_axis_au") -> DataFrame:
    """Rows with lo <= axis < hi; none if the column is absent."""
    if axis not in df.columns:
        return df.where(F.lit(False))
    return df.where((F.col(axis) >= lo) & (F.col(axis) < hi))


def in_groups(df: DataFrame, *groups: str) -> DataFrame:
    return df.where(F.col("comp_group").isin(*groups))


def measured_only(df: DataFrame) -> DataFrame:
    return df.where(~F.col("derived_diameter_is_estimate"))


def sorted_for_write(df: DataFrame, *by: str) -> DataFrame:
    """Range-partitioned and sorted: a total order over the written parts."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def top_with_share(df: DataFrame, value: str, n: int, key: str = "designation") -> DataFrame:
    """The ``n`` largest and each one's share of the total."""
    total = df.agg(F.sum(value).alias("_total"))
    top = df.orderBy(F.desc_nulls_last(value), key).limit(n)
    return top.join(F.broadcast(total), F.lit(True)).withColumn("share", F.col(value) / F.col("_total")).drop("_total")


def head(df: DataFrame, n: int, *by: str) -> DataFrame:
    return df.orderBy(*by).limit(n)


def duplicated(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def value_counts(df: DataFrame, col: str | Column, name: str = "value") -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count("*").alias("n"))
