"""Fixture views over the driver's tables, one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.plans.staging import staged

VIEWS = {
    "fx_orbits": """
WITH k0 AS (SELECT CAST(p_partkey AS BIGINT) AS k FROM part),
k1 AS (SELECT k, 8e0 + (k*7 % 140)/1e1 AS h, 4e-2 + (CAST(floor(k/8e0) AS BIGINT) % 8)*5e-2 AS p FROM k0),
k2 AS (SELECT k, h, p, round((CASE WHEN k % 101 = 0 THEN 1e1 ELSE 1e0 END) * (1e0 + ((k % 7) - 3)/2e1) * 1329e0/sqrt(p)*pow(1e1, -h/5e0), 4) AS d FROM k1)
SELECT CAST(k+1 AS STRING) AS designation,
 CASE WHEN k % 4 = 0 THEN 'Name' || CAST(k AS STRING) END AS name,
 CAST(1950 + k % 70 AS STRING) || ' '
   || substr('ABCDEFGHJKLMNOPQRSTUVWXY', CAST(floor(k/7e1) AS INT) % 24 + 1, 1)
   || substr('ABCDEFGHJKLMNOPQRSTUVWXYZ', CAST(floor(k/168e1) AS INT) % 25 + 1, 1)
   || CAST(1 + CAST(floor(k/42e3) AS INT) AS STRING) AS provisional_designation,
 h AS absolute_magnitude_h,
 CASE WHEN k % 5 < 2 THEN d END AS diameter_km,
 CASE WHEN k % 5 = 0 THEN d/2e1 WHEN k % 5 = 1 THEN 0e0 END AS diameter_sigma_km,
 CASE WHEN k % 97 = 0 THEN 1e0 WHEN k % 6 = 0 THEN p END AS albedo,
 CASE WHEN k % 4 = 0 THEN (CASE WHEN k % 36 = 8 THEN 2e2 WHEN k % 20 = 0 THEN 2e1 ELSE 1e0 END) * (CASE k % 9 WHEN 1 THEN 36e-1 WHEN 7 THEN 9e-1 WHEN 8 THEN 44e-1 ELSE 15e-1 + (k % 3) END) * 1e3 * 0.5235987755982988e0 * d * d * d * 1e9 END AS estimated_mass_kg,
 CASE WHEN k % 3 = 0 THEN 1e0 + (k % 200)/1e1 END AS rotation_period_h,
 CASE WHEN k % 20 = 0 THEN 1e0 + (k % 300)/1e3 WHEN k % 50 = 1 THEN 51e-1 + (k % 30)/1e2 WHEN k % 50 = 2 THEN 3e1 + (k % 150)/1e1 WHEN k % 61 = 0 THEN NULL ELSE 2e0 + (k*37 % 140)/1e2 END AS semi_major_axis_au,
 (k % 20 = 0) AS is_neo,
 CASE k % 9 WHEN 0 THEN 'S' WHEN 1 THEN 'c' WHEN 2 THEN 'SQ' WHEN 3 THEN 'X' WHEN 4 THEN '-' WHEN 6 THEN 'Xc' WHEN 7 THEN 'V' WHEN 8 THEN 'Sq2' END AS spectral_type,
 CASE WHEN k % 11 = 0 THEN 'M' WHEN k % 13 = 0 THEN '<NA>' END AS spectral_type_tholen,
 CASE WHEN k % 13 <> 5 THEN (k % 90)/1e2 END AS eccentricity, (k % 300)/1e1 AS inclination_deg, (k*7 % 360)*1e0 AS longitude_asc_node_deg,
 (k*11 % 360)*1e0 AS arg_perihelion_deg, (k*13 % 360)*1e0 AS mean_anomaly_deg, 24e5 + k % 1000 AS element_epoch_jd
FROM k2
""",
    "fx_best": """
SELECT CASE WHEN CAST(designation AS BIGINT) % 10 = 3 THEN lower(provisional_designation) WHEN CAST(designation AS BIGINT) % 10 = 4 THEN '(' || designation || ') Best' ELSE designation END AS designation,
 CASE WHEN CAST(designation AS BIGINT) % 20 <> 1 THEN diameter_km * (CASE WHEN CAST(designation AS BIGINT) % 17 = 0 THEN 13e-1 ELSE 102e-2 END) END AS diameter_km,
 CASE WHEN CAST(designation AS BIGINT) % 20 <> 1 THEN diameter_km / 25e0 END AS diameter_sigma_km,
 albedo * 78e-2 AS albedo,
 CASE WHEN CAST(designation AS BIGINT) % 8 = 1 AND diameter_km IS NOT NULL THEN estimated_mass_kg * 98e-2 END AS estimated_mass_kg,
 CASE WHEN diameter_km IS NULL THEN NULL WHEN CAST(designation AS BIGINT) % 96 = 1 THEN estimated_mass_kg * 2e0 WHEN CAST(designation AS BIGINT) % 8 = 1 THEN estimated_mass_kg / 1e1 END AS estimated_mass_sigma_kg,
 absolute_magnitude_h + (CAST(designation AS BIGINT) % 5)/1e1 AS absolute_magnitude_h,
 CASE WHEN CAST(designation AS BIGINT) % 8 = 0 THEN 17e2 + (CAST(designation AS BIGINT) % 9)*5e2 END / 1e3 AS density_gcm3
FROM fx_orbits WHERE CAST(designation AS BIGINT) % 7 <> 0
""",
    "fx_fits": """
SELECT CASE WHEN l_linenumber % 7 = 1 THEN CAST(l_partkey+1 AS STRING) || '.0' ELSE CAST(l_partkey+1 AS STRING) END AS designation,
 l_quantity AS diameter_km, l_tax*1e1 AS diameter_sigma_km,
 CASE WHEN l_linenumber = 5 THEN -999e-3 ELSE l_discount END AS albedo, l_tax/2e0 AS albedo_sigma,
 CASE l_linenumber % 4 WHEN 0 THEN 'DV--' WHEN 1 THEN 'DVB-' WHEN 2 THEN 'DVBI' ELSE 'DV' END AS fit_code,
 l_returnflag AS reference, CASE l_linestatus WHEN 'O' THEN 'Y' ELSE '' END AS stacked
FROM lineitem WHERE l_partkey % 7 <> 2 AND l_partkey % 7 <> 3
""",
    "fx_compendium": """
SELECT lpad(designation, 5, '0') AS packed, provisional_designation AS name,
 CASE WHEN CAST(designation AS BIGINT) % 19 = 0 THEN 0e0 WHEN CAST(designation AS BIGINT) % 20 <> 1 THEN diameter_km END AS diameter_km,
 CASE WHEN CAST(designation AS BIGINT) % 23 = 0 THEN 9999e-2 WHEN CAST(designation AS BIGINT) % 29 = 0 THEN 0e0 ELSE absolute_magnitude_h END AS absolute_magnitude_h,
 CASE WHEN CAST(designation AS BIGINT) % 12 = 0 THEN 'Family' || CAST(CAST(designation AS BIGINT) % 5 AS STRING) END AS family,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN coalesce(semi_major_axis_au, 27e-1) + 1e-3 END AS semi_major_axis_au,
 CASE WHEN CAST(designation AS BIGINT) % 8 = 2 THEN 11e-2 END AS eccentricity,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN inclination_deg + 1e-2 END AS inclination_deg,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN longitude_asc_node_deg END AS longitude_asc_node_deg,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN arg_perihelion_deg END AS arg_perihelion_deg,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN mean_anomaly_deg END AS mean_anomaly_deg,
 CASE WHEN CAST(designation AS BIGINT) % 4 = 2 THEN 245e4 END AS element_epoch_jd
FROM fx_orbits WHERE CAST(designation AS BIGINT) % 3 <> 0
""",
    "fx_links": """
SELECT CAST(1820 + CAST(designation AS BIGINT) % 80 AS STRING) || substr(provisional_designation, 5) AS alias,
 CASE WHEN CAST(designation AS BIGINT) % 2 = 0 THEN designation ELSE provisional_designation END AS to_designation
FROM fx_orbits WHERE CAST(designation AS BIGINT) % 6 = 5
""",
}


#: The build's fits leave out two bodies in seven, so that some bodies have none. Queries
#: about the fits themselves take every row.
WHOLE = {**VIEWS, "fx_fits": VIEWS["fx_fits"].replace(" WHERE l_partkey % 7 <> 2 AND l_partkey % 7 <> 3", "")}


def views(spark: SparkSession, sf_dir: str, texts: dict[str, str] = VIEWS, written: bool = False) -> dict[str, DataFrame]:
    """The fixture views as DataFrames, by name.

    With ``written`` the bodies, from which other views are made, are written once, by as
    many tasks as run at a time: a small file of many short rows is read by few tasks.
    """
    out: dict[str, DataFrame] = {}
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "lineitem")}
    if written:
        tables["part"] = tables["part"].select("p_partkey").repartition(spark.sparkContext.defaultParallelism)
    for name, text in texts.items():
        used = {k: v for k, v in {**tables, **out}.items() if f"FROM {k}" in text}
        for k in used:
            text = text.replace(f"FROM {k}", "FROM {" + k + "}")
        out[name] = spark.sql(text, **used)
        if written and name == "fx_orbits":
            out[name] = staged(out[name], name)
    return out

