"""DuckDB common table expressions that mirror the build, written independently:
the Spark side is DataFrame code, this side is plain SQL."""

from __future__ import annotations

import re

from orrery.functions import dims
from orrery.plans.fixtures import VIEWS, WHOLE

_PROV = r"^((?:18|19|20)\d{2})\s+([A-HJ-Ya-hj-y][A-HJ-Za-hj-z]\d*)$"
_SURV = r"^(\d{4})\s+([Pp]-[Ll]|[Tt]-[123])$"
_MISS = "('', 'nan', 'NaN', 'None', 'none', '<NA>')"
_MISS_CLASS = "('', '-', 'nan', 'NaN', 'None', 'none', '<NA>', 'NA')"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return f"'{v}'"
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)

    text = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (SELECT * FROM (VALUES {text}) AS t)"


def canon(name: str, raw: str) -> str:
    """A CTE (raw, canon) over the text expression list ``raw`` (a SELECT of raw)."""
    return rf"""{name} AS (
SELECT raw, trim(raw) AS s0, regexp_extract(s0, '^\(\s*(\d+)\s*\)', 1) AS lead,
 regexp_replace(s0, '^(\d+)\.0+$', '\1') AS s2,
 regexp_matches(s2, '{_PROV}') AS isp, regexp_matches(s2, '{_SURV}') AS iss,
 CASE WHEN isp THEN regexp_extract(s2, '{_PROV}', 1) || ' ' || upper(regexp_extract(s2, '{_PROV}', 2))
  WHEN iss THEN regexp_extract(s2, '{_SURV}', 1) || ' ' || upper(regexp_extract(s2, '{_SURV}', 2)) ELSE s2 END AS s3,
 regexp_replace(s3, '^(\d{{4}} [A-Z]{{2}})0$', '\1') AS s4,
 CASE WHEN NOT (isp OR iss) THEN nullif(regexp_extract(s4, '^(\d+)\s+(?:[A-Z][a-z]|[A-Za-z]{{3,}}$)', 1), '') END AS num,
 coalesce(nullif(lead, ''), num, s4) AS o,
 CASE WHEN regexp_matches(o, '^\d+$') THEN CASE WHEN ltrim(o, '0') = '' THEN '0' ELSE ltrim(o, '0') END ELSE o END AS o2,
 CASE WHEN o2 NOT IN {_MISS} THEN o2 END AS canon
FROM ({raw}))"""


KEYS = (
    [
        canon(
            "ck",
            "SELECT DISTINCT raw FROM (SELECT designation AS raw FROM fx_orbits UNION ALL SELECT name FROM fx_orbits "
            "UNION ALL SELECT provisional_designation FROM fx_orbits UNION ALL SELECT designation FROM fx_best "
            "UNION ALL SELECT designation FROM fx_fits UNION ALL SELECT alias FROM fx_links "
            "UNION ALL SELECT to_designation FROM fx_links UNION ALL SELECT name FROM fx_compendium) WHERE raw IS NOT NULL",
        ),
        """alias_pairs AS (
SELECT upper(trim(k.canon)) AS alias, d.canon AS tod FROM fx_orbits o JOIN ck d ON d.raw = o.designation
 JOIN ck k ON k.raw = o.designation OR k.raw = o.provisional_designation OR k.raw = o.name)""",
        "aliases AS (SELECT alias, min(tod) AS tod FROM alias_pairs WHERE alias IS NOT NULL AND tod IS NOT NULL GROUP BY 1 HAVING count(DISTINCT tod) = 1)",
        """linked AS (SELECT upper(trim(a.canon)) AS alias, min(t.canon) AS tod FROM fx_links l JOIN ck a ON a.raw = l.alias
 JOIN ck t ON t.raw = l.to_designation GROUP BY 1 HAVING count(DISTINCT t.canon) = 1)""",
        """rk AS (SELECT c.raw, coalesce(a.tod, a2.tod, l.tod, c.canon) AS key FROM ck c
 LEFT JOIN aliases a ON a.alias = upper(trim(c.canon)) LEFT JOIN linked l ON l.alias = upper(trim(c.canon))
 LEFT JOIN aliases a2 ON a2.alias = upper(trim(l.tod)))""",
    ]
)

_FIT0 = """fit0 AS (SELECT rk.key AS designation, fit_code, reference,
 CASE WHEN stacked IN ('Y', '1') THEN true WHEN stacked IN ('N', '0', '') THEN false END AS stacked,
 rpad(fit_code, 4, '-') AS code, diameter_km AS d, diameter_sigma_km AS ds, albedo AS p, albedo_sigma AS ps
 FROM fx_fits JOIN rk ON rk.raw = fx_fits.designation)"""
_FIT = """fit AS (SELECT designation, fit_code, reference, stacked,
 CASE WHEN substr(code, 1, 1) = 'D' AND d >= 0 AND coalesce(ds, 0) >= 0 THEN d END AS diameter_km,
 CASE WHEN substr(code, 1, 1) = 'D' AND coalesce(d, 0) >= 0 AND ds > 0 THEN ds END AS diameter_sigma_km,
 CASE WHEN substr(code, 2, 1) = 'V' AND p >= 0 AND coalesce(ps, 0) >= 0 THEN p END AS albedo,
 CASE WHEN substr(code, 2, 1) = 'V' AND coalesce(p, 0) >= 0 AND ps > 0 THEN ps END AS albedo_sigma FROM fit0)"""


def _pool(v: str, s: str, short: str) -> list[str]:
    return [
        f"""w{short} AS (SELECT designation, {v} AS v, {s} AS s,
 coalesce(bool_or({s} > 0 AND {v} IS NOT NULL) OVER (PARTITION BY designation), false) AS anyw,
 CASE WHEN {v} IS NOT NULL AND {s} > 0 THEN 1/({s}*{s}) WHEN {v} IS NOT NULL AND NOT anyw THEN 1e0 END AS w FROM fit)""",
        f"m{short} AS (SELECT designation, sum(w*v)/sum(w) AS mean, sum(w) AS sw, max(v) AS v1, max(s) AS s1, count(*) AS n, bool_or(anyw) AS anyw FROM w{short} GROUP BY 1)",
        f"q{short} AS (SELECT designation, sum(w*(v - mean)*(v - mean)) AS ss FROM w{short} JOIN (SELECT designation, mean FROM m{short}) USING (designation) GROUP BY 1)",
        f"""p{short} AS (SELECT designation, CASE WHEN n = 1 THEN v1 ELSE mean END AS v, CASE WHEN n = 1 THEN s1 ELSE
 greatest(CASE WHEN anyw THEN 1/sqrt(sw) END, sqrt(ss/sw)) END AS s FROM m{short} JOIN q{short} USING (designation))""",
    ]


SRC = (
    [
        """so AS (SELECT k.canon AS key, fx_orbits.* FROM fx_orbits JOIN ck k ON k.raw = fx_orbits.designation)""",
        """sb AS (SELECT rk.key, fx_best.* FROM fx_best JOIN rk ON rk.raw = fx_best.designation)""",
        _FIT0,
        _FIT,
        *_pool("diameter_km", "diameter_sigma_km", "d"),
        *_pool("albedo", "albedo_sigma", "p"),
        """pooled AS (SELECT d.designation AS key, d.v AS diameter_km, d.s AS diameter_sigma_km, p.v AS albedo, p.s AS albedo_sigma,
 f.stacked, f.n_fits FROM pd d JOIN pp p USING (designation)
 JOIN (SELECT designation, bool_or(coalesce(stacked, false)) AS stacked, count(*) AS n_fits FROM fit GROUP BY 1) f USING (designation))""",
        """sc AS (SELECT coalesce(a.tod, ltrim(packed, '0')) AS key,
 CASE WHEN diameter_km > 0 THEN diameter_km END AS diameter_km,
 CASE WHEN absolute_magnitude_h <> 0 AND absolute_magnitude_h < 90 THEN absolute_magnitude_h END AS absolute_magnitude_h,
 nullif(trim(family), '') AS family, semi_major_axis_au, eccentricity, inclination_deg FROM fx_compendium LEFT JOIN aliases a ON a.alias = ltrim(packed, '0'))""",
    ]
)

MERGED = (
    [
        "allkeys AS (SELECT key FROM so UNION SELECT key FROM sb UNION SELECT key FROM pooled UNION SELECT key FROM sc)",
        """m AS (SELECT k.key AS designation, o.name, o.provisional_designation, o.is_neo,
 CASE WHEN o.semi_major_axis_au IS NOT NULL AND o.eccentricity IS NOT NULL THEN 'orbits' WHEN c.semi_major_axis_au IS NOT NULL AND c.eccentricity IS NOT NULL THEN 'compendium'
  WHEN o.inclination_deg IS NOT NULL THEN 'orbits' WHEN c.inclination_deg IS NOT NULL THEN 'compendium' END AS orbit_provider,
 CASE orbit_provider WHEN 'orbits' THEN o.semi_major_axis_au WHEN 'compendium' THEN c.semi_major_axis_au END AS semi_major_axis_au,
 CASE orbit_provider WHEN 'orbits' THEN o.eccentricity WHEN 'compendium' THEN c.eccentricity END AS eccentricity,
 CASE orbit_provider WHEN 'orbits' THEN o.inclination_deg WHEN 'compendium' THEN c.inclination_deg END AS inclination_deg, o.spectral_type,
 o.spectral_type_tholen, b.density_gcm3, f.n_fits, f.stacked, c.family,
 o.absolute_magnitude_h AS h_o, b.absolute_magnitude_h AS h_b, c.absolute_magnitude_h AS h_c,
 CASE WHEN o.diameter_km > 0 THEN o.diameter_km END AS d_o, CASE WHEN b.diameter_km > 0 THEN b.diameter_km END AS d_b,
 CASE WHEN f.diameter_km > 0 THEN f.diameter_km END AS d_f, CASE WHEN c.diameter_km > 0 THEN c.diameter_km END AS d_c,
 CASE WHEN o.diameter_sigma_km > 0 THEN o.diameter_sigma_km END AS ds_o, CASE WHEN b.diameter_sigma_km > 0 THEN b.diameter_sigma_km END AS ds_b,
 CASE WHEN f.diameter_sigma_km > 0 THEN f.diameter_sigma_km END AS ds_f,
 CASE WHEN o.albedo > 0 THEN o.albedo END AS p_o, CASE WHEN b.albedo > 0 THEN b.albedo END AS p_b, CASE WHEN f.albedo > 0 THEN f.albedo END AS p_f,
 CASE WHEN f.albedo_sigma > 0 THEN f.albedo_sigma END AS ps_f,
 CASE WHEN o.estimated_mass_kg > 0 THEN o.estimated_mass_kg END AS m_o, CASE WHEN b.estimated_mass_kg > 0 THEN b.estimated_mass_kg END AS m_b,
 CASE WHEN b.estimated_mass_sigma_kg > 0 THEN b.estimated_mass_sigma_kg END AS ms_b, o.rotation_period_h AS t_o,
 o.key IS NOT NULL AS is_o, b.key IS NOT NULL AS is_b, f.key IS NOT NULL AS is_f, c.key IS NOT NULL AS is_c
 FROM allkeys k LEFT JOIN so o ON o.key = k.key LEFT JOIN sb b ON b.key = k.key LEFT JOIN pooled f ON f.key = k.key LEFT JOIN sc c ON c.key = k.key)""",
        values("cls", "class, grp, density, metal, silicate, carbon, ice, pgm", dims.class_rows()),
        values("lim", "grp, ceiling", dims.pairs(dims.CEILINGS)),
        f"""lab AS (SELECT designation, CASE WHEN spectral_type NOT IN {_MISS_CLASS} THEN upper(substr(spectral_type, 1, 1)) || lower(substr(spectral_type, 2)) END AS c1,
 CASE WHEN spectral_type_tholen NOT IN {_MISS_CLASS} THEN upper(substr(spectral_type_tholen, 1, 1)) || lower(substr(spectral_type_tholen, 2)) END AS c2 FROM m)""",
        """grps AS (SELECT l.designation, l.c1, l.c2, coalesce(e.grp, r.grp, 'Unknown') AS grp, coalesce(lim.ceiling, 8e0) AS hi FROM lab l
 LEFT JOIN cls e ON e.class = coalesce(c1, c2) LEFT JOIN cls r ON r.class = substr(coalesce(c1, c2), 1, 1)
 LEFT JOIN lim ON lim.grp = coalesce(e.grp, r.grp, 'Unknown'))""",
    ]
)

_IMP = "pow(1329e0/{d}*pow(1e1, -{h}/5e0), 2e0)"
_RHO = "{m}/(pi()/6*pow({d}*1e3, 3e0))/1e3"


def _bad_d(x: str) -> str:
    p = _IMP.format(d=x, h="h")
    return f"coalesce({p} < 1e-2*pow(1e1, -3e-1) OR {p} > pow(1e1, 3e-1), false)"


def _names(pairs: list[tuple[str, str]]) -> str:
    return "nullif(concat_ws(';', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in pairs) + "), '')"


RESOLVED = (
    [
        """r1 AS (SELECT m.*, g.grp, g.hi, g.c1, g.c2, coalesce(h_o, h_b, h_c) AS h,
 CASE WHEN h_o IS NOT NULL THEN 'orbits' WHEN h_b IS NOT NULL THEN 'best' WHEN h_c IS NOT NULL THEN 'compendium' END AS h_prov,
 CAST(h_o IS NOT NULL AS BIGINT) + CAST(h_b IS NOT NULL AS BIGINT) + CAST(h_c IS NOT NULL AS BIGINT) AS h_n,
 greatest(h_o, h_b, h_c) - least(h_o, h_b, h_c) AS h_spread FROM m JOIN grps g USING (designation))""",
        f"r2 AS (SELECT *, {', '.join(f'{_bad_d("d_" + s)} AS nd_{s}' for s in 'obfc')} FROM r1)",
        """r3 AS (SELECT *, CASE WHEN d_o IS NOT NULL AND NOT nd_o THEN 'orbits' WHEN d_b IS NOT NULL AND NOT nd_b THEN 'best'
 WHEN d_f IS NOT NULL AND NOT nd_f THEN 'fits' WHEN d_c IS NOT NULL AND NOT nd_c THEN 'compendium' END AS d_prov0,
 CASE d_prov0 WHEN 'orbits' THEN d_o WHEN 'best' THEN d_b WHEN 'fits' THEN d_f WHEN 'compendium' THEN d_c END AS d0,
 CASE d_prov0 WHEN 'orbits' THEN ds_o WHEN 'best' THEN ds_b WHEN 'fits' THEN ds_f END AS ds0,
 CAST(d_o IS NOT NULL AS BIGINT) + CAST(d_b IS NOT NULL AS BIGINT) + CAST(d_f IS NOT NULL AS BIGINT) + CAST(d_c IS NOT NULL AS BIGINT) AS d_n,
 greatest(d_o, d_b, d_f, d_c)/least(d_o, d_b, d_f, d_c) - 1 AS d_spread, """
        + _names([("nd_o", "orbits"), ("nd_b", "best"), ("nd_f", "fits"), ("nd_c", "compendium")])
        + """ AS d_out0,
 coalesce(p_o >= 1 OR p_o < 1e-2, false) AS np_o, coalesce(p_b >= 1 OR p_b < 1e-2, false) AS np_b, coalesce(p_f >= 1 OR p_f < 1e-2, false) AS np_f,
 CASE WHEN p_o IS NOT NULL AND NOT np_o THEN 'orbits' WHEN p_b IS NOT NULL AND NOT np_b THEN 'best' WHEN p_f IS NOT NULL AND NOT np_f THEN 'fits' END AS p_prov,
 CASE p_prov WHEN 'orbits' THEN p_o WHEN 'best' THEN p_b WHEN 'fits' THEN p_f END AS p, CASE p_prov WHEN 'fits' THEN ps_f END AS ps,
 CAST(p_o IS NOT NULL AS BIGINT) + CAST(p_b IS NOT NULL AS BIGINT) + CAST(p_f IS NOT NULL AS BIGINT) AS p_n,
 greatest(p_o, p_b, p_f)/least(p_o, p_b, p_f) - 1 AS p_spread, """
        + _names([("np_o", "orbits"), ("np_b", "best"), ("np_f", "fits")])
        + " AS p_out FROM r2)",
        f"""r4 AS (SELECT *, {_RHO.format(m="m_o", d="(CASE WHEN NOT nd_o THEN d_o END)")} AS ro_o, {_RHO.format(m="m_b", d="(CASE WHEN NOT nd_b THEN d_b END)")} AS ro_b,
 {_RHO.format(m="m_o", d="d0")} AS rc_o, {_RHO.format(m="m_b", d="d0")} AS rc_b, coalesce(ms_b >= m_b, false) AS sig_b FROM r3)""",
        """r5 AS (SELECT *, coalesce(ro_o BETWEEN 25e-2 AND hi, false) AS ok_o, coalesce(ro_b BETWEEN 25e-2 AND hi, false) AS ok_b,
 m_o IS NOT NULL AND (ro_o IS NOT NULL OR rc_o IS NOT NULL) AND NOT (ok_o OR coalesce(rc_o BETWEEN 25e-2 AND hi, false)) AS imp_o,
 m_b IS NOT NULL AND NOT sig_b AND (ro_b IS NOT NULL OR rc_b IS NOT NULL) AND NOT (ok_b OR coalesce(rc_b BETWEEN 25e-2 AND hi, false)) AS imp_b,
 (imp_o OR imp_b) AND NOT ((m_o IS NOT NULL AND NOT imp_o) OR (m_b IS NOT NULL AND NOT sig_b AND NOT imp_b))
  AND CAST(m_o IS NOT NULL AS INT) + CAST(m_b IS NOT NULL AND NOT sig_b AS INT) > CAST(d_o IS NOT NULL AND NOT nd_o AS INT) + CAST(d_b IS NOT NULL AND NOT nd_b AS INT)
   + CAST(d_f IS NOT NULL AND NOT nd_f AS INT) + CAST(d_c IS NOT NULL AND NOT nd_c AS INT) AS drop_d,
 imp_o AND NOT drop_d AS nm_o, sig_b OR (imp_b AND NOT drop_d) AS nm_b,
 CASE WHEN m_b IS NOT NULL AND NOT nm_b THEN 'best' WHEN m_o IS NOT NULL AND NOT nm_o THEN 'orbits' END AS m_prov,
 CASE m_prov WHEN 'best' THEN m_b WHEN 'orbits' THEN m_o END AS mass, CASE m_prov WHEN 'best' THEN ms_b END AS mass_s,
 CAST(m_o IS NOT NULL AS BIGINT) + CAST(m_b IS NOT NULL AS BIGINT) AS m_n, greatest(m_o, m_b)/least(m_o, m_b) - 1 AS m_spread, """
        + _names([("nm_o", "orbits"), ("nm_b", "best")])
        + """ AS m_out,
 CASE WHEN drop_d THEN NULL ELSE d0 END AS d1, CASE WHEN drop_d THEN NULL ELSE ds0 END AS ds1, CASE WHEN drop_d THEN NULL ELSE d_prov0 END AS d_prov1,
 CASE WHEN drop_d THEN nullif(concat_ws(';', d_out0, """
        + _names([(f"d_{s} IS NOT NULL AND NOT nd_{s}", n) for s, n in zip("obfc", ("orbits", "best", "fits", "compendium"))])
        + """), '') ELSE d_out0 END AS d_out,
 CASE m_prov WHEN 'best' THEN ok_b WHEN 'orbits' THEN ok_o ELSE false END AND NOT drop_d AS pairable,
 CASE m_prov WHEN 'best' THEN d_b WHEN 'orbits' THEN d_o END AS d_own, CASE m_prov WHEN 'best' THEN ds_b WHEN 'orbits' THEN ds_o END AS ds_own,
 pairable AND d_own IS DISTINCT FROM d1 AS swap FROM r4)""",
        """rs AS (SELECT *, CASE WHEN swap THEN d_own ELSE d1 END AS d, CASE WHEN swap THEN ds_own ELSE ds1 END AS ds, CASE WHEN swap THEN m_prov ELSE d_prov1 END AS d_prov,
 CASE WHEN d > 0 THEN d ELSE 1329e0*pow(1e1, -h/5e0) END AS small,
 coalesce(small >= 1e1 AND t_o < sqrt(3e0*pi()/(667430e-16*1e3*hi))/36e2, false) AS nt_o,
 CASE WHEN NOT nt_o THEN t_o END AS t, CASE WHEN t_o IS NOT NULL AND NOT nt_o THEN 'orbits' END AS t_prov, CASE WHEN nt_o THEN 'orbits' END AS t_out FROM r5)""",
    ]
)

_BELT = " ".join(f"WHEN a >= {lo!r} AND a < {hi!r} THEN {v!r}" for lo, hi, v in dims.BELT_BANDS)
_NEO = " ".join(f"WHEN a >= {lo!r} AND a < {hi!r} THEN {v!r}" for lo, hi, v in dims.NEO_BANDS)
_HB = " ".join(f"WHEN h <= {hi!r} THEN {v!r}" for hi, v in dims.H_BANDS)

DERIVED = (
    [
        values("ca", "class, albedo", dims.pairs(dims.CLASS_ALBEDO)),
        values("sv", "designation, vol, vols", dims.SHAPE_VOLUMES),
        """v0 AS (SELECT rs.* EXCLUDE (d, ds, d_prov), coalesce(cbrt(6e0*vol/pi()), d) AS d, CASE WHEN vol IS NOT NULL THEN cbrt(6e0*vol/pi())*vols/(3e0*vol) ELSE ds END AS ds,
 CASE WHEN vol IS NOT NULL THEN 'shape model' ELSE d_prov END AS d_prov, semi_major_axis_au AS a FROM rs LEFT JOIN sv USING (designation))""",
        f"""v1 AS (SELECT v0.*, coalesce(CASE WHEN trim(spectral_type) NOT IN {_MISS_CLASS} THEN trim(spectral_type) END, CASE WHEN trim(spectral_type_tholen) NOT IN {_MISS_CLASS} THEN trim(spectral_type_tholen) END) AS tax FROM v0)""",
        f"""v2 AS (SELECT v1.*, coalesce(e.albedo, r.albedo) AS p_tax,
 CAST(coalesce(CASE WHEN a >= 5.5 THEN CASE {_HB} END END, CASE WHEN coalesce(is_neo, false) THEN CASE {_NEO} END END, CASE {_BELT} END) AS DOUBLE) AS p_orb,
 CAST(coalesce(CASE WHEN coalesce(is_neo, false) THEN CASE {_NEO} END END, CASE {_BELT} END, 0.078) AS DOUBLE) AS p_gap
 FROM v1 LEFT JOIN ca e ON e.class = tax LEFT JOIN ca r ON r.class = substr(tax, 1, 1))""",
        """v3 AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN 'measured_albedo' WHEN p_tax IS NOT NULL THEN 'taxonomy_albedo' WHEN p_orb IS NOT NULL THEN 'orbit_albedo' ELSE 'fallback_albedo' END AS p_label,
 coalesce(CASE WHEN p > 0 AND p < 1 THEN p END, p_tax, p_orb, 78e-3) AS p_best, coalesce(d > 0, false) AS d_meas, 1329e0/sqrt(p_best)*pow(1e1, -h/5e0) AS d_h,
 NOT d_meas AND coalesce(d_h > 0, false) AS fills FROM v2)""",
        """dv AS (SELECT v3.* EXCLUDE (d), CASE WHEN fills THEN d_h ELSE d END AS d, CASE WHEN d_meas THEN 'measured' WHEN fills THEN 'derived_h_' || p_label ELSE 'none' END AS d_src,
 NOT d_meas AS d_est, CASE WHEN fills THEN p_best END AS p_ass FROM v3)""",
        """vl AS (SELECT *, CASE WHEN designation IS NULL OR trim(designation) = '' THEN 'missing designation' WHEN isinf(d) THEN 'non-finite diameter'
 WHEN NOT coalesce(d > 0, false) THEN 'missing or non-positive diameter' WHEN isinf(a) THEN 'non-finite semi-major axis'
 WHEN NOT coalesce(a > 0, false) THEN 'missing or non-positive semi-major axis' END AS reason FROM dv)""",
    ]
)

ENRICHED = (
    [
        """n1 AS (SELECT *, coalesce(p_ass, CASE WHEN NOT coalesce(p > 0, false) THEN p_gap END) AS p_any,
 CASE WHEN c1 IS NOT NULL THEN 'source' WHEN c2 IS NOT NULL THEN 'tholen' WHEN a > 46e-1 THEN 'orbit' WHEN p IS NOT NULL THEN 'albedo' WHEN p_any IS NOT NULL THEN 'albedo_assumed' ELSE 'unknown' END AS c_src,
 CASE c_src WHEN 'source' THEN c1 WHEN 'tholen' THEN c2 WHEN 'orbit' THEN 'D' WHEN 'albedo' THEN CASE WHEN p < 1e-1 THEN 'C' ELSE 'S' END
  WHEN 'albedo_assumed' THEN CASE WHEN p_any < 1e-1 THEN 'C' ELSE 'S' END END AS cls_ FROM vl WHERE reason IS NULL)""",
        """n2a AS (SELECT n1.*, coalesce(e.class, r.class, 'Unknown') AS key_, CASE WHEN a > 55e-1 THEN 'D' ELSE key_ END AS row_
 FROM n1 LEFT JOIN cls e ON e.class = cls_ LEFT JOIN cls r ON r.class = substr(cls_, 1, 1))""",
        """n2 AS (SELECT n2a.*, g.grp AS lgrp,
 CASE WHEN row_ IN ('X', 'Xc') AND p > 0 AND p < 1 THEN CASE WHEN p < 1e-1 THEN 'P' WHEN p < 3e-1 THEN 'M' ELSE 'E' END ELSE row_ END AS comp
 FROM n2a JOIN cls g ON g.class = row_)""",
        """n3 AS (SELECT n2.*, c.grp AS comp_group, c.density AS rho_est, c.metal, c.silicate, c.carbon, c.ice, c.pgm,
 coalesce(l1.ceiling, 8e0) AS m_hi, coalesce(l2.ceiling, 8e0) AS c_hi FROM n2 JOIN cls c ON c.class = comp
 LEFT JOIN lim l1 ON l1.grp = CASE WHEN c_src IN ('source', 'tholen') THEN lgrp ELSE 'Unknown' END LEFT JOIN lim l2 ON l2.grp = lgrp)""",
        f"""n4 AS (SELECT *, CASE WHEN density_gcm3 BETWEEN 25e-2 AND m_hi THEN density_gcm3 END AS rho_src,
 {_RHO.format(m="mass", d="d")} AS rho_md, cbrt(6e0*mass/(1e3*rho_est)/pi())/1e3 AS d_m,
 mass IS NOT NULL AND d_est AND NOT coalesce(rho_md BETWEEN 25e-2 AND c_hi, false) AS refuted,
 {_IMP.format(d="d_m", h="h")} AS p_m, refuted AND coalesce(d_m > 0 AND (p_m IS NULL OR (p_m >= 1e-2 AND p_m < 1)), false) AS fits_, refuted AND NOT fits_ AS unfit FROM n3)""",
        f"""en AS (SELECT n4.* EXCLUDE (d, mass, m_out, m_prov, mass_s, d_src, p_ass), CASE WHEN fits_ THEN d_m ELSE d END AS d, CASE WHEN unfit THEN NULL ELSE mass END AS mass_src,
 CASE WHEN fits_ THEN 'derived_mass' ELSE d_src END AS d_src, CASE WHEN NOT fits_ THEN p_ass END AS p_ass,
 CASE WHEN unfit THEN nullif(concat_ws(';', m_out, m_prov), '') ELSE m_out END AS m_out, CASE WHEN NOT unfit THEN m_prov END AS m_prov, CASE WHEN NOT unfit THEN mass_s END AS mass_s FROM n4)""",
        f"""fin AS (SELECT *, mass_src IS NOT NULL AS mass_meas, CASE WHEN mass_meas THEN {_RHO.format(m="mass_src", d="d")} ELSE coalesce(rho_src, rho_est) END AS rho,
 (mass_meas AND NOT d_est) OR (NOT mass_meas AND rho_src IS NOT NULL) AS rho_meas, coalesce(mass_src, rho*1e3*pi()/6*pow(d*1e3, 3e0)) AS mass FROM en)""",
    ]
)

LEVELS = {"fx": [f"{name} AS ({text})" for name, text in VIEWS.items()]}
for _level, _before, _ctes in (
    ("keys", "fx", KEYS),
    ("src", "keys", SRC),
    ("merged", "src", MERGED),
    ("resolved", "merged", RESOLVED),
    ("derived", "resolved", DERIVED),
    ("enriched", "derived", ENRICHED),
):
    LEVELS[_level] = [*LEVELS[_before], *_ctes]

#: The text of a query -> its level, final SELECT and further CTEs, for a reader
#: that has the tables of a level already.
PARTS: dict[str, tuple[str, str, list[str]]] = {}


def name_of(cte: str) -> str:
    return re.match(r"\w+", cte).group()


def whole(level: str, select: str) -> str:
    """A query over the tables of ``level`` with the fits of every row, see WHOLE."""
    text = "WITH " + ",\n".join([*[f"{n} AS ({t})" for n, t in WHOLE.items()], *LEVELS[level][len(VIEWS) :]])
    return f"{text}\n{select}".replace("AS STRING)", "AS VARCHAR)")


def sql(level: str, select: str, *more: str) -> str:
    """A query over the tables of ``level``, with further CTEs if any; one that the
    level has already is left out."""
    have = {name_of(c) for c in LEVELS[level]}
    own = [c for c in more if name_of(c) not in have]
    text = "WITH " + ",\n".join([*LEVELS[level], *own]) + f"\n{select}"
    text = text.replace("AS STRING)", "AS VARCHAR)")
    PARTS[text] = (level, select, own)
    return text
