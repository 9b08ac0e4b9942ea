"""Whole-table audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import dims
from orrery.functions import physics as P
from orrery.operators.validate import counted, infinite

#: Keys whose diameter must be measured.
REFERENCE_KEYS = ["1", "2", "4", "16", "433"]


def implied_density() -> Column:
    return P.bulk_density(F.col("estimated_mass_kg"), F.col("diameter_km"))


def physical_rules(columns: list[str]) -> list[tuple[str, Column]]:
    """Values that no body can have, at the loosest limits of any class."""
    c, has = F.col, set(columns)
    lo, hi = P.DENSITY_FLOOR, P.DENSITY_CEILING_ANY
    measured = c("diameter_source") == "measured" if "diameter_source" in has else F.lit(True)
    rules = [(f"{n} is not finite", infinite(n)) for n in ("diameter_km", "estimated_mass_kg", "density_gcm3", "semi_major_axis_au") if n in has]
    if {"estimated_mass_kg", "diameter_km", "density_gcm3"} <= has:
        rho = c("density_gcm3")
        rules += [
            ("mass and diameter without density", c("estimated_mass_kg").isNotNull() & c("diameter_km").isNotNull() & rho.isNull()),
            ("implied density impossible", (implied_density() < lo) | (implied_density() > hi)),
            ("density impossible", (rho < lo) | (rho > hi)),
            ("mass is not density x volume", F.abs(F.try_divide(implied_density(), rho) - 1) > 1e-6),
        ]
    if {"estimated_mass_sigma_kg", "mass_measured"} <= has:
        rules.append(("mass sigma without a measured mass", c("estimated_mass_sigma_kg").isNotNull() & ~F.coalesce(c("mass_measured"), F.lit(False))))
    if "albedo" in has:
        rules += [("albedo too high", c("albedo") >= P.ALBEDO_CEILING), ("albedo too low", c("albedo") < P.ALBEDO_FLOOR)]
    if {"absolute_magnitude_h", "diameter_km"} <= has:
        p = P.implied_albedo(c("absolute_magnitude_h"), c("diameter_km"))
        rules.append(("measured diameter contradicts H", measured & ((p < P.IMPLIED_FLOOR) | (p > P.IMPLIED_CEILING))))
    if "rotation_period_h" in has:
        size = P.smallest_diameter(F.when(measured, c("diameter_km")), c("absolute_magnitude_h"))
        rules.append(("spin faster than breakup", P.spins_too_fast(c("rotation_period_h"), size, F.lit(hi))))
    return rules


def suspect_rules(columns: list[str]) -> list[tuple[str, Column]]:
    """Values that are possible but should be looked at. ``_lo`` and ``_hi`` are
    the density limits of the source-given class (see ``with_class_limits``)."""
    c, has = F.col, set(columns)
    mass_m = F.coalesce(c("mass_measured"), F.lit(False))
    d_m = F.coalesce(c("diameter_source") == "measured", F.lit(False))
    p, rho = P.implied_albedo(c("absolute_magnitude_h"), c("diameter_km")), implied_density()
    rules = [
        ("measured mass outside its class's density", mass_m & ((rho < c("_lo")) | (rho > c("_hi")))),
        ("measured mass above 5 g/cm3", mass_m & (rho > 5.0)),
        ("implied albedo above 1", d_m & (p > 1.0)),
        ("implied albedo below 0.01", d_m & (p < 0.01)),
    ]
    rules += [
        (f"{stem} sources disagree", c(f"{stem}_spread") > factor)
        for stem, factor in (("diameter", 1.0), ("albedo", 2.0), ("mass", 1.0), ("rotation_period", 1.0))
    ]
    rules += [
        ("diameter sources differ 1000x", F.abs(c("diameter_spread") - 999) < 5),
        ("h sources disagree", c("h_spread") > 1.0),
        ("period sources differ 2x", F.abs(c("rotation_period_spread") - 1.0) < 0.02),
        ("large mass sigma", mass_m & (c("estimated_mass_sigma_kg") >= 0.5 * c("estimated_mass_kg"))),
        ("large albedo sigma", c("albedo_sigma") >= c("albedo")),
        ("no mass", c("estimated_mass_kg").isNull()),
    ]
    rules += [
        (f"{stem} value refused", c(f"{stem}_screened_out").isNotNull())
        for stem in ("diameter", "albedo", "mass", "rotation_period")
        if f"{stem}_screened_out" in has
    ]
    return rules


def with_class_limits(df: DataFrame, spark: SparkSession) -> DataFrame:
    sourced = F.col("spectral_type_source").isin("source", "tholen")
    lim = dims.density_limits(spark).select(F.col("grp").alias("_g"), F.col("floor").alias("_lo"), F.col("ceiling").alias("_hi"))
    df = df.withColumn("_g", F.when(sourced, F.col("_limits_group")).otherwise("Unknown"))
    df = df.join(F.broadcast(lim), "_g", "left").drop("_g")
    return df.withColumns({"_lo": F.coalesce("_lo", F.lit(P.DENSITY_FLOOR)), "_hi": F.coalesce("_hi", F.lit(P.DENSITY_CEILING_ANY))})


def violations(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, n_rows, examples): every rule that any row breaks, in one scan."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules]))
    each = df.select("designation", F.explode(broken).alias("_rule"))
    return counted(each, "_rule", name="rule").withColumnRenamed("rejected_count", "n_rows")


def source_counts(df: DataFrame, known: list[str], spark: SparkSession) -> DataFrame:
    """(source, n): rows per source; every known source, 0 if it has none."""
    listed = df.select(F.explode(F.split("sources", ";")).alias("source")).groupBy("source").agg(F.count("*").alias("n"))
    names = spark.createDataFrame([(k,) for k in known], "source string")
    return names.join(listed, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("n"))


def reference_check(df: DataFrame, spark: SparkSession, keys: list[str] = REFERENCE_KEYS) -> DataFrame:
    """(designation, status): ok, missing or the diameter source that is not measured."""
    want = spark.createDataFrame([(k,) for k in keys], "designation string")
    have = df.groupBy("designation").agg(F.min("diameter_source").alias("src"), F.count("*").alias("n"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("src") == "measured", "ok").otherwise(F.coalesce("src", F.lit("none")))
    return F.broadcast(want).join(have, "designation", "left").select("designation", status.alias("status"))
