"""Row rules with an accounted rejection log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.cleaning import MISSING_CLASSES, is_blank

EXAMPLES = 5
LOG_SCHEMA = "reason string, rejected_count long, examples array<string>"


def infinite(name: str) -> Column:
    return F.coalesce(F.abs(F.col(name)) == float("inf"), F.lit(False))


def not_positive(name: str) -> Column:
    return ~F.coalesce(F.col(name) > 0, F.lit(False))


def row_rules(columns: list[str], strict_class: bool = False) -> list[tuple[str, Column]]:
    """The rules in order; a row is counted under the first that it breaks."""
    rules = [
        ("missing designation", is_blank(F.col("designation"))),
        ("non-finite diameter", infinite("diameter_km")),
        ("missing or non-positive diameter", not_positive("diameter_km")),
    ]
    if "semi_major_axis_au" in columns:
        rules += [
            ("non-finite semi-major axis", infinite("semi_major_axis_au")),
            ("missing or non-positive semi-major axis", not_positive("semi_major_axis_au")),
        ]
    if strict_class:
        cls = [c for c in ("spectral_type", "spectral_type_tholen") if c in columns]
        none = reduce(lambda a, b: a & b, [is_blank(F.col(c), MISSING_CLASSES) for c in cls], F.lit(True))
        rules.append(("no spectral class", none))
    return rules


def gate_rules(min_diameter_km: float = 0.0) -> list[tuple[str, Column]]:
    """Rules after enrichment; a missing diameter passes the size rule."""
    small = F.coalesce(F.col("diameter_km") < min_diameter_km, F.lit(False))
    return [
        ("non-finite diameter after enrichment", infinite("diameter_km")),
        ("non-finite mass", infinite("estimated_mass_kg")),
        ("non-finite density", infinite("density_gcm3")),
        ("diameter below the minimum", small),
    ]


def with_reason(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("_reason", F.coalesce(*[F.when(bad, name) for name, bad in rules], F.lit(None).cast("string")))


def counted(marked: DataFrame, reason: str, key: str = "designation", name: str = "reason") -> DataFrame:
    """(reason, rejected_count, examples): the smallest keys as examples.

    Counts have a partial step. Examples are the first few of each salt, then of
    each reason; a ranking that is cut keeps only these in every task, so a reason
    that holds most rows does not gather them.
    """
    rows = marked.where(F.col(reason).isNotNull()).select(
        F.col(reason).alias(name), F.col(key).cast("string").alias("k"), F.pmod(F.xxhash64(key), F.lit(64)).alias("salt")
    )

    def first(df: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("k"))
        return df.withColumn("rank", rank).where(F.col("rank") <= EXAMPLES).drop("rank")

    few = first(first(rows.where("k is not null"), name, "salt"), name)
    examples = few.groupBy(name).agg(F.array_sort(F.collect_list("k")).alias("examples"))
    total = rows.groupBy(name).agg(F.count("*").alias("rejected_count")).join(examples, name, "left")
    return total.select(name, "rejected_count", F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def split(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the log of those that do not."""
    marked = with_reason(df, rules)
    return marked.where("_reason is null").drop("_reason"), counted(marked, "_reason")
