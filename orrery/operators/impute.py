"""Labelled imputation: the albedo cascade and diameters derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import dims, physics
from orrery.functions.cleaning import MISSING_CLASSES, strip


def band_value(x: Column, bands: list[tuple]) -> Column:
    """The value of the half-open band [lo, hi) that holds ``x``, else NULL."""
    out = None
    for lo, hi, v in bands:
        hit = (x >= lo) & (x < hi)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out


def first_band(x: Column, bands: list[tuple]) -> Column:
    """The value of the first band whose upper end is not passed."""
    out = None
    for hi, v in bands:
        out = F.when(x <= hi, v) if out is None else out.when(x <= hi, v)
    return out


def orbit_albedo(a: Column, neo: Column, h: Column | None) -> Column:
    """Albedo from the orbit: by H past the outer edge, then near-Earth bands for
    near-Earth bodies, then the bands of the belt."""
    steps = [F.when(F.coalesce(neo, F.lit(False)), band_value(a, dims.NEO_BANDS)), band_value(a, dims.BELT_BANDS)]
    if h is not None:
        steps.insert(0, F.when(a >= dims.OUTER_EDGE, first_band(h, dims.H_BANDS)))
    return F.coalesce(*steps)


def usable_class(df: DataFrame) -> Column:
    """The first class column that holds a class, as it is written."""
    cols = [c for c in ("spectral_type", "spectral_type_tholen") if c in df.columns]
    return F.coalesce(*[F.when(~strip(F.col(c)).isin(MISSING_CLASSES), strip(F.col(c))) for c in cols], F.lit(None).cast("string"))


def albedo_cascade(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` with ``_albedo`` and ``_albedo_label``, the best that is known.

    A measured albedo inside (0, 1); the class median (exact class, then its first
    letter); the orbit; a last resort.
    """
    dim = dims.class_albedo(spark)
    exact = F.broadcast(dim.select(F.col("class").alias("_cls"), F.col("albedo").alias("_p_exact")))
    root = F.broadcast(dim.select(F.col("class").alias("_root"), F.col("albedo").alias("_p_root")))
    df = df.withColumn("_cls", usable_class(df)).withColumn("_root", F.substring("_cls", 1, 1))
    df = df.join(exact, "_cls", "left").join(root, "_root", "left")
    p = F.col("albedo")
    label = lambda value, name: F.when(value.isNotNull(), F.struct(value.alias("p"), F.lit(name).alias("l")))
    best = F.coalesce(
        label(F.when((p > 0) & (p < 1), p), "measured_albedo"),
        label(F.coalesce("_p_exact", "_p_root"), "taxonomy_albedo"),
        label(orbit_albedo(F.col("semi_major_axis_au"), F.col("is_neo"), F.col("absolute_magnitude_h")), "orbit_albedo"),
        label(F.lit(dims.LAST_RESORT_ALBEDO), "fallback_albedo"),
    )
    out = df.withColumn("_best", best)
    return out.withColumns({"_albedo": F.col("_best.p"), "_albedo_label": F.col("_best.l")}).drop("_best", "_cls", "_root", "_p_exact", "_p_root")


def derive_diameters(df: DataFrame, spark: SparkSession, floor_km: float = 0.0, enabled: bool = True) -> DataFrame:
    """Fill missing diameters from magnitude and albedo; never overwrite one.

    Adds ``diameter_source``, ``derived_diameter_is_estimate`` and
    ``albedo_assumed_for_diameter``. ``floor_km`` applies to derived values only.
    """
    measured = F.coalesce(F.col("diameter_km") > 0, F.lit(False))
    if not enabled:
        return df.withColumns(
            {
                "diameter_source": F.when(measured, "measured").otherwise("none"),
                "derived_diameter_is_estimate": ~measured,
                "albedo_assumed_for_diameter": F.lit(None).cast("double"),
            }
        )
    df = albedo_cascade(df, spark).withColumn(
        "_d", physics.diameter_from_h(F.col("absolute_magnitude_h"), F.col("_albedo"))
    )
    d = F.col("_d")
    fills = ~measured & F.coalesce((d > 0) & (d < float("inf")) & (d >= floor_km), F.lit(False))
    df = df.withColumns({"_fills": fills, "_measured": measured})
    out = df.withColumns(
        {
            "diameter_km": F.when(F.col("_fills"), d).otherwise(F.col("diameter_km")),
            "diameter_source": F.when(F.col("_measured"), "measured")
            .when(F.col("_fills"), F.concat(F.lit("derived_h_"), "_albedo_label"))
            .otherwise("none"),
            "derived_diameter_is_estimate": ~F.col("_measured"),
            "albedo_assumed_for_diameter": F.when(F.col("_fills"), F.col("_albedo")),
        }
    )
    return out.drop("_d", "_fills", "_measured", "_albedo", "_albedo_label")
