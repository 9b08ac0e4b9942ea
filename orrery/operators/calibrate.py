"""Calibration: the lookup tables re-derived from the table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orrery.operators.quantile import exact_medians

MIN_SAMPLE = 5
BEYOND_AU = 5.5


def usable_albedo() -> Column:
    return (F.col("albedo") > 0) & (F.col("albedo") < 1)


def albedo_by_class(df: DataFrame) -> DataFrame:
    """(class, median, n) over source-given classes, at least MIN_SAMPLE bodies."""
    rows = df.where((F.col("spectral_type_source") == "source") & usable_albedo())
    return exact_medians(rows.withColumn("class", F.col("spectral_type")), ["class"], "albedo").where(F.col("n") >= MIN_SAMPLE)


def albedo_by_band(df: DataFrame, bands: DataFrame, neo: bool, provider: str) -> DataFrame:
    """(a_min, median, n) per orbital band; empty bands are reported."""
    rows = df.where((F.coalesce("is_neo", F.lit(False)) == neo) & usable_albedo() & (F.col("albedo_provider") == provider)).select("semi_major_axis_au", F.col("albedo").alias("p"))
    b = F.broadcast(bands.select("a_min", "a_max"))
    a = F.col("semi_major_axis_au")
    seen = exact_medians(rows.join(b, (a >= F.col("a_min")) & (a < F.col("a_max"))), ["a_min"], "p")
    return b.select("a_min").join(seen, "a_min", "left").select("a_min", "median", F.coalesce("n", F.lit(0)).alias("n"))


def albedo_beyond(df: DataFrame, h_bands: DataFrame) -> DataFrame:
    """(h_max, median, n) of consecutive H bands past the outer edge."""
    lower = F.lag("h_max").over(W.orderBy("h_max"))  # a band table of five rows
    b = F.broadcast(h_bands.select("h_max", F.coalesce(lower, F.lit(float("-inf"))).alias("h_min")))
    rows = df.where((F.col("semi_major_axis_au") >= BEYOND_AU) & usable_albedo()).select("absolute_magnitude_h", "albedo")
    h = F.col("absolute_magnitude_h")
    seen = exact_medians(rows.join(b, (h > F.col("h_min")) & (h <= F.col("h_max"))), ["h_max"], "albedo")
    return h_bands.select("h_max").join(seen, "h_max", "left").select("h_max", "median", F.coalesce("n", F.lit(0)).alias("n"))


def albedo_overall(df: DataFrame, provider: str) -> DataFrame:
    """(median): one row, NULL where the provider gives no usable albedo."""
    rows = df.where(usable_albedo() & (F.col("albedo_provider") == provider)).select("albedo", F.lit("all").alias("of"))
    return exact_medians(rows, ["of"], "albedo").agg(F.max("median").alias("median"))


def drift(computed: DataFrame, committed: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """(class, now, committed, drift, status) of a re-derived table."""
    both = computed.select("class", F.col("median").alias("now")).join(committed.select("class", F.col("albedo").alias("committed")), "class", "full")
    d = F.abs(F.col("now") / F.col("committed") - 1)
    status = F.when(F.col("committed").isNull(), "not in the table").when(F.col("now").isNull(), "unfillable").when(d > tolerance, "drifted").otherwise("ok")
    return both.select("class", "now", "committed", d.alias("drift"), status.alias("status"))


def measured_bodies(df: DataFrame, max_sigma: float = 0.20) -> DataFrame:
    """Bodies fit for density evidence."""
    share = F.try_divide(F.col("estimated_mass_sigma_kg"), F.col("estimated_mass_kg"))
    return df.where(
        F.col("spectral_type_source").isin("source", "tholen")
        & F.col("mass_measured") & F.col("density_measured")
        & (share > 0) & (share <= max_sigma) & (F.col("semi_major_axis_au") < BEYOND_AU)
    ).select("designation", "spectral_type", "comp_class", "density_gcm3", "albedo", (F.col("density_gcm3") * share).alias("sigma"))


def density_stats(bodies: DataFrame, *by: str) -> DataFrame:
    """n, mean, sample SD, median and weighted mean of density per group."""
    w = F.try_divide(F.lit(1.0), F.col("sigma") * F.col("sigma"))
    means = bodies.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("density_gcm3").alias("mean"), F.stddev_samp("density_gcm3").alias("sd"),
        (F.sum(w * F.col("density_gcm3")) / F.sum(w)).alias("weighted"),
    )
    medians = exact_medians(bodies, list(by), "density_gcm3").drop("n")
    return means.join(medians, list(by)).select(*by, "n", "mean", "sd", "median", "weighted")


def albedo_bin() -> Column:
    p = F.col("albedo")
    return F.when(p < 0.10, "P").when(p < 0.30, "M").otherwise("E")


def x_bins(bodies: DataFrame) -> DataFrame:
    rows = bodies.where(F.col("spectral_type").startswith("X") & usable_albedo())
    return density_stats(rows.withColumn("bin", albedo_bin()), "bin")


def x_split_counts(df: DataFrame) -> DataFrame:
    """(class, p, m, e): bodies per albedo bin of X and Xc inside the outer edge."""
    rows = df.where(F.col("spectral_type").isin("X", "Xc") & usable_albedo() & (F.col("semi_major_axis_au") < BEYOND_AU)).withColumn("b", albedo_bin())
    return rows.groupBy(F.col("spectral_type").alias("class")).agg(*[F.count_if(F.col("b") == x).alias(x.lower()) for x in "PME"])


def mixture_check(counts: DataFrame, classes: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(class, mixture, density, status): count-weighted mixture against the table."""
    each = counts.select("class", F.stack(F.lit(3), F.lit("P"), "p", F.lit("M"), "m", F.lit("E"), "e").alias("member", "k"))
    dim = F.broadcast(classes.select(F.col("class").alias("member"), F.col("density").alias("rho")))
    mix = each.join(dim, "member").groupBy("class").agg((F.sum(F.col("k") * F.col("rho")) / F.sum("k")).alias("mixture"))
    own = F.broadcast(classes.select("class", "density"))
    off = F.abs(F.col("mixture") - F.col("density")) > tolerance
    return mix.join(own, "class").select("class", "mixture", "density", F.when(off, "off").otherwise("ok").alias("status"))


def class_verdict(stats: DataFrame, classes: DataFrame, reasons: DataFrame | None = None) -> DataFrame:
    """Class estimate against what was measured: too high or too low by two SD.

    ``reasons`` (class, reason) documents why an estimate may be below what is measured;
    such a class is ok, and its reason is given, where it would be too low.
    """
    dim = F.broadcast(classes.select(F.col("class").alias("comp_class"), "density"))
    j = stats.join(dim, "comp_class")
    why = F.lit(None).cast("string")
    if reasons is not None:
        j = j.join(F.broadcast(reasons.select(F.col("class").alias("comp_class"), F.col("reason").alias("_why"))), "comp_class", "left")
        why = F.col("_why")
    rho, mean, two = F.col("density"), F.col("mean"), 2 * F.col("sd")
    low = rho < mean - two
    v = F.when(F.col("n") < 3, "not judged").when(rho > mean + two, "too high").when(low & why.isNull(), "too low").otherwise("ok")
    return j.select("comp_class", "n", "density", v.alias("verdict"), F.when(low & (F.col("n") >= 3), why).alias("reason"))
