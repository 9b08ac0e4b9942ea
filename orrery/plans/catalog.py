"""The catalog build: landed sources to one published row per body."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import dims
from orrery.functions.cleaning import class_label, mask_sentinels, mask_unfitted, stacked_flag, tidy_text
from orrery.functions.keys import canonical, number_or_name, unpack_number
from orrery.operators import classify, impute, release, resolve, validate
from orrery.operators.counts import Watch
from orrery.operators.distinct import per_distinct
from orrery.operators.identity import alias_map, name_map, rekey
from orrery.operators.merge import SourceSpec, active, judge_overlap, merge, override_diameters
from orrery.operators.pool import pool
from orrery.operators.survivor import combine_shared
from orrery.plans.staging import staged

ORDER = ["orbits", "best", "fits", "compendium"]
VERSION = "1.0"
#: The elements that a complete orbit has, and all fields of an orbit.
ELEMENTS = ("semi_major_axis_au", "eccentricity", "inclination_deg", "longitude_asc_node_deg", "arg_perihelion_deg", "mean_anomaly_deg", "element_epoch_jd")
ORBIT = (*ELEMENTS, "perihelion_au", "aphelion_au", "orbital_period_yr", "mean_motion_deg_day", "element_epoch_timescale")
RECORDS = [["diameter_km", "diameter_sigma_km"], ["albedo", "albedo_sigma"], ["estimated_mass_kg", "estimated_mass_sigma_kg"]]


def clean_fits(fits: DataFrame) -> DataFrame:
    """Raw fits with unfitted slots and bad pairs blanked."""
    return mask_unfitted(fits.withColumn("stacked", stacked_flag(F.col("stacked"))))


def fits_source(fits: DataFrame) -> DataFrame:
    """Raw fits: keys made whole, unfitted slots and bad pairs blanked."""
    return clean_fits(per_distinct(fits, ["designation"], {"designation": canonical(F.col("designation"))}))


def pooled(fits: DataFrame) -> DataFrame:
    """One row per body of keyed fits."""
    pairs = [("diameter_km", "diameter_sigma_km"), ("albedo", "albedo_sigma")]
    return pool(fits, pairs, texts=("reference", "fit_code"), flags=("stacked",), count="n_fits")


def pooled_fits(fits: DataFrame) -> DataFrame:
    return pooled(fits_source(fits))


def compendium_source(raw: DataFrame) -> DataFrame:
    """Keys from packed numbers, else from the name; placeholders blanked."""
    number = unpack_number(F.col("packed"))
    out = raw.select(
        number_or_name(number, F.col("name")).alias("designation"),
        "diameter_km",
        "absolute_magnitude_h",
        tidy_text(F.col("family")).alias("family"),
        *[c for c in ORBIT if c in raw.columns],
    )
    return mask_sentinels(out)


def _dedup(df: DataFrame) -> DataFrame:
    """Rows of a source that share a body in one; its orbit is that of one row."""
    records = [[c for c in r if c in df.columns] for r in RECORDS]
    orbit = [c for c in ORBIT if c in df.columns]
    return combine_shared(df, records=[r for r in records if len(r) > 1], loose=[orbit] if ORBIT[0] in orbit else None)


def sources(views: dict[str, DataFrame]) -> list[SourceSpec]:
    """The sources in precedence order, re-keyed, pooled and deduplicated."""
    orbits = views["fx_orbits"].withColumn("designation", canonical(F.col("designation")))
    names = staged(name_map(alias_map(orbits), views["fx_links"]), "names")
    # Written, since the search for shared keys and what it parts read them again.
    best = staged(rekey(views["fx_best"], names), "best")
    compendium = staged(rekey(compendium_source(views["fx_compendium"]), names), "compendium")
    fits = rekey(clean_fits(views["fx_fits"]), names)
    return [
        SourceSpec("orbits", _dedup(orbits)),
        SourceSpec("best", _dedup(best)),
        SourceSpec("fits", pooled(fits)),
        SourceSpec("compendium", _dedup(compendium)),
    ]


def held_records(columns: list[str]) -> list[list[str]]:
    """Columns of the wide table that travel together: each source's value with its
    sigma, the orbit with its provider, and the counts of sources with their names."""
    value_and_sigma = [[f"{c}__{s}" for c in r] for r in RECORDS for s in ORDER]
    records = [["orbit_provider", *ORBIT], ["n_sources", "sources"], *value_and_sigma]
    return [r for r in ([c for c in r if c in columns] for r in records) if len(r) > 1]


def merged(views: dict[str, DataFrame], spark: SparkSession, policy: str = "warn") -> DataFrame:
    """The wide table, with ``grp``, the group of the merged class label.

    Rows that still share a body, under case variants of a key, become one. A source
    that meets no body of those before it is reported as ``policy`` says (see Watch).
    """
    watch, used = Watch(policy), sources(views)
    wide = staged(merge(used, resolve.HELD, whole=ORBIT, required=ELEMENTS, watch=watch), "wide")
    judge_overlap(watch, used)
    wide = combine_shared(wide, records=held_records(wide.columns))
    label = F.coalesce(class_label(F.col("spectral_type")), class_label(F.col("spectral_type_tholen")))
    row = classify.dimension_row(label)
    group = F.create_map(*[F.lit(x) for r in dims.class_rows() for x in r[:2]])[row]
    return per_distinct(wide, ["spectral_type", "spectral_type_tholen"], {"grp": group})


def resolved(views: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """The merged table is written first, so that neither plan nor code outgrows
    what the code generator takes."""
    return resolve.resolve(staged(merged(views, spark), "merged"), ORDER, dims.density_limits(spark))


@dataclass
class Catalog:
    table: DataFrame
    rejections: DataFrame


def derived(wide: DataFrame, spark: SparkSession) -> DataFrame:
    """Shape-model sizes, then derived diameters, on a resolved table."""
    return impute.derive_diameters(override_diameters(wide, dims.shape_volumes(spark)), spark)


def enriched(kept: DataFrame, spark: SparkSession) -> DataFrame:
    """Classes, composition with phases, and reconciled mass, density and diameter."""
    return classify.reconcile(classify.add_composition(classify.classify(kept), spark))


def build(views: dict[str, DataFrame], spark: SparkSession, date: str, min_diameter_km: float = 0.0) -> Catalog:
    """The finished catalog and the log of everything that was rejected."""
    table = staged(derived(staged(resolved(views, spark), "resolved"), spark), "derived")
    kept, first = validate.split(table, validate.row_rules(table.columns))
    full = staged(enriched(kept, spark), "enriched")
    gated, second = validate.split(full, validate.gate_rules(min_diameter_km))
    stamped = gated.withColumns({"catalog_date": F.lit(date), "pipeline_version": F.lit(VERSION)})
    return Catalog(stamped.drop("_limits_group"), first.unionByName(second))


def publish(views: dict[str, DataFrame], spark: SparkSession, date: str, path: str, floors: dict[str, int]) -> DataFrame:
    done = build(views, spark, date)
    problems, found = release.gate(done.table, VERSION, floors, row_floor=1, measured_floor=1, previous=release.previous(spark, path))
    return release.publish(done.table, done.rejections, path, date, problems, found)


def active_sources(views: dict[str, DataFrame], limits: dict[str, int]) -> list[SourceSpec]:
    """Sources after toggles and caps (a cap of 0 is none, -1 switches off)."""
    out = sources(views)
    for s in out:
        s.limit = max(0, limits.get(s.name, 0))
        s.enabled = limits.get(s.name, 0) >= 0
    return active(out)
