"""Resolution of measured quantities across sources.

Each quantity comes as one column per source (``value__source``). The quantities
resolve in a fixed order, since later screens use earlier results: magnitude,
diameter, albedo, mass, rotation period. Screens refuse a source's value before
precedence applies; refused values still count in the number of sources and the
spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions import physics as P
from orrery.functions.cleaning import any_of, joined_names


@dataclass(frozen=True)
class Quantity:
    value: str
    sigma: str | None
    stem: str
    ratio: bool
    tolerance: float
    prefer: tuple[str, ...] = ()


QUANTITIES = {
    q.stem: q
    for q in (
        Quantity("absolute_magnitude_h", "absolute_magnitude_h_sigma", "h", False, 0.30),
        Quantity("diameter_km", "diameter_sigma_km", "diameter", True, 0.10),
        Quantity("albedo", "albedo_sigma", "albedo", True, 0.25),
        Quantity("estimated_mass_kg", "estimated_mass_sigma_kg", "mass", True, 0.25, ("best",)),
        Quantity("rotation_period_h", None, "rotation_period", True, 0.02),
    )
}
HELD = {c for q in QUANTITIES.values() for c in (q.value, q.sigma) if c}


def _sources(df: DataFrame, q: Quantity, order: list[str]) -> list[str]:
    return [s for s in order if f"{q.value}__{s}" in df.columns]


def hygiene(df: DataFrame, q: Quantity, order: list[str]) -> DataFrame:
    """``_v_``, ``_s_`` and ``_inf_`` columns per source: no infinities, no
    non-positive ratios, no sigma that is not above zero."""
    new: dict[str, Column] = {}
    for s in _sources(df, q, order):
        v = F.col(f"{q.value}__{s}")
        infinite = F.coalesce(F.abs(v) == F.lit(float("inf")), F.lit(False))
        fine = ~infinite & (v > 0) if q.ratio else ~infinite
        new[f"_inf_{q.stem}__{s}"] = infinite
        new[f"_v_{q.stem}__{s}"] = F.when(fine, v)
        sigma = f"{q.sigma}__{s}"
        new[f"_s_{q.stem}__{s}"] = (
            F.when(F.col(sigma) > 0, F.col(sigma)) if q.sigma and sigma in df.columns else F.lit(None).cast("double")
        )
    return df.withColumns(new)


def pick(df: DataFrame, q: Quantity, order: list[str], refused: dict[str, Column] | None, screened: bool) -> DataFrame:
    """Value, sigma and provider of the first usable source, and how sources agree.

    ``_picked_<stem>`` names the chosen source. The refusals become columns.
    """
    have = _sources(df, q, order)
    if not have:
        return df
    refused = refused or {}
    df = df.withColumns({f"_no_{q.stem}__{s}": F.coalesce(refused.get(s, F.lit(False)), F.lit(False)) for s in have})
    v = {s: F.col(f"_v_{q.stem}__{s}") for s in have}
    rank = [s for s in q.prefer if s in have] + [s for s in have if s not in q.prefer]
    bundle = F.coalesce(
        *[
            F.when(
                v[s].isNotNull() & ~F.col(f"_no_{q.stem}__{s}"),
                F.struct(v[s].alias("value"), F.col(f"_s_{q.stem}__{s}").alias("sigma"), F.lit(s).alias("source")),
            )
            for s in rank
        ]
    )
    count = sum([v[s].isNotNull().cast("long") for s in have], F.lit(0).cast("long"))
    hi = F.greatest(*v.values()) if len(have) > 1 else v[have[0]]
    lo = F.least(*v.values()) if len(have) > 1 else v[have[0]]
    spread = hi / lo - 1 if q.ratio else hi - lo
    df = df.withColumns({"_b": bundle, f"{q.stem}_n_sources": count, f"{q.stem}_spread": spread})
    new = {
        q.value: F.col("_b.value"),
        f"{q.stem}_provider": F.col("_b.source"),
        f"_picked_{q.stem}": F.col("_b.source"),
        f"{q.stem}_sources_agree": F.when(F.col(f"{q.stem}_n_sources") >= 2, F.col(f"{q.stem}_spread") <= q.tolerance),
    }
    if q.sigma:
        new[q.sigma] = F.col("_b.sigma")
    if screened:
        out = {s: F.col(f"_no_{q.stem}__{s}") | F.col(f"_inf_{q.stem}__{s}") for s in have}
        new[f"{q.stem}_screened_out"] = joined_names(out)
    return df.withColumns(new).drop("_b")


def screen_albedo(df: DataFrame, order: list[str]) -> dict[str, Column]:
    q = QUANTITIES["albedo"]
    v = {s: F.col(f"_v_albedo__{s}") for s in _sources(df, q, order)}
    return {s: (x >= P.ALBEDO_CEILING) | (x < P.ALBEDO_FLOOR) for s, x in v.items()}


def screen_diameter(df: DataFrame, order: list[str]) -> dict[str, Column]:
    """Diameters that the resolved magnitude puts at an albedo no surface has."""
    out = {}
    for s in _sources(df, QUANTITIES["diameter"], order):
        p = P.implied_albedo(F.col("absolute_magnitude_h"), F.col(f"_v_diameter__{s}"))
        out[s] = (p < P.IMPLIED_FLOOR) | (p > P.IMPLIED_CEILING)
    return out


def screen_spin(df: DataFrame, order: list[str]) -> dict[str, Column]:
    size = P.smallest_diameter(F.col("diameter_km"), F.col("absolute_magnitude_h"))
    return {
        s: P.spins_too_fast(F.col(f"_v_rotation_period__{s}"), size, F.col("_ceiling"))
        for s in _sources(df, QUANTITIES["rotation_period"], order)
    }


def _within(rho: Column) -> Column:
    return F.coalesce((rho >= F.col("_floor")) & (rho <= F.col("_ceiling")), F.lit(False))


def resolve_mass(df: DataFrame, order: list[str]) -> DataFrame:
    """Mass with its screens, the vote between mass and diameter, and pairing.

    A mass is refused for a sigma as large as itself, or if it can be tested and
    neither its own source's diameter nor the resolved one gives a density that
    the class group allows. Where density alone refuses every mass and more
    sources report a mass than stand behind the diameter, the diameter goes
    instead. A picked mass then takes its own source's diameter along, if that
    pair is possible.
    """
    q = QUANTITIES["mass"]
    have = _sources(df, q, order)
    if not have:
        return df
    d_have = _sources(df, QUANTITIES["diameter"], order)
    no_d = F.lit(None).cast("double")
    own = {
        s: F.when(~F.col(f"_no_diameter__{s}"), F.col(f"_v_diameter__{s}")) if s in d_have else no_d for s in have
    }
    m = {s: F.col(f"_v_mass__{s}") for s in have}
    layer: dict[str, Column] = {}
    for s in have:
        layer[f"_own_{s}"] = own[s]
        layer[f"_rho_own_{s}"] = P.bulk_density(m[s], own[s])
        layer[f"_rho_cat_{s}"] = P.bulk_density(m[s], F.col("diameter_km"))
        layer[f"_sig_{s}"] = F.coalesce(F.col(f"_s_mass__{s}") >= m[s], F.lit(False))
    df = df.withColumns(layer)
    layer = {}
    for s in have:
        ok = _within(F.col(f"_rho_own_{s}"))
        tested = F.col(f"_rho_own_{s}").isNotNull() | F.col(f"_rho_cat_{s}").isNotNull()
        layer[f"_ok_{s}"] = ok
        layer[f"_imp_{s}"] = m[s].isNotNull() & ~F.col(f"_sig_{s}") & tested & ~(ok | _within(F.col(f"_rho_cat_{s}")))
    df = df.withColumns(layer)
    standing = any_of([m[s].isNotNull() & ~F.col(f"_sig_{s}") & ~F.col(f"_imp_{s}") for s in have])
    stuck = any_of([F.col(f"_imp_{s}") for s in have]) & ~standing
    d_stand = {s: F.col(f"_v_diameter__{s}").isNotNull() & ~F.col(f"_no_diameter__{s}") for s in d_have}
    votes = sum([(m[s].isNotNull() & ~F.col(f"_sig_{s}")).cast("int") for s in have], F.lit(0))
    against = sum([x.cast("int") for x in d_stand.values()], F.lit(0))
    df = df.withColumn("_drop_d", stuck & (votes > against) if d_have else F.lit(False))
    drop = F.col("_drop_d")
    if d_have:
        moved = F.when(drop, joined_names(d_stand))
        both = F.nullif(F.concat_ws(";", "diameter_screened_out", moved), F.lit(""))
        df = df.withColumns(
            {
                "diameter_screened_out": both,
                "diameter_km": F.when(~drop, F.col("diameter_km")),
                "diameter_sigma_km": F.when(~drop, F.col("diameter_sigma_km")),
                "diameter_provider": F.when(~drop, F.col("diameter_provider")),
            }
        )
    df = pick(df, q, order, {s: F.col(f"_sig_{s}") | (F.col(f"_imp_{s}") & ~drop) for s in have}, True)
    at = F.col("_picked_mass")
    chosen = F.coalesce(*[F.when(at == s, F.struct(F.col(f"_own_{s}").alias("d"), F.col(f"_ok_{s}").alias("ok"), (F.col(f"_s_diameter__{s}") if s in d_have else no_d).alias("s"))) for s in have])
    df = df.withColumn("_pair", chosen)
    swap = F.coalesce(F.col("_pair.ok") & ~drop & ~F.col("_pair.d").eqNullSafe(F.col("diameter_km")), F.lit(False))
    df = df.withColumn("_swap", swap)
    return df.withColumns(
        {
            "diameter_km": F.when(F.col("_swap"), F.col("_pair.d")).otherwise(F.col("diameter_km")),
            "diameter_sigma_km": F.when(F.col("_swap"), F.col("_pair.s")).otherwise(F.col("diameter_sigma_km")),
            "diameter_provider": F.when(F.col("_swap"), at).otherwise(F.col("diameter_provider")),
        }
    )


def resolve(df: DataFrame, order: list[str], limits: DataFrame, keep_work: bool = False) -> DataFrame:
    """All quantities of a merged table; ``limits`` (group, floor, ceiling) is
    joined by column ``grp``, the class group of the merged label."""
    # A quantity that no source carries is NULL while others are judged, and not
    # in the result; a stray sigma without its value is not either.
    absent: list[str] = []
    for q in QUANTITIES.values():
        df = hygiene(df, q, order)
        if not _sources(df, q, order):
            absent += [c for c in (q.value, q.sigma) if c]
    df = df.withColumns({c: F.lit(None).cast("double") for c in absent})
    lim = F.broadcast(limits.select("grp", F.col("floor").alias("_floor"), F.col("ceiling").alias("_ceiling")))
    df = df.join(lim, "grp", "left").withColumns(
        {"_floor": F.coalesce("_floor", F.lit(P.DENSITY_FLOOR)), "_ceiling": F.coalesce("_ceiling", F.lit(P.DENSITY_CEILING_ANY))}
    )
    df = pick(df, QUANTITIES["h"], order, None, False)
    df = pick(df, QUANTITIES["diameter"], order, screen_diameter(df, order), True)
    df = pick(df, QUANTITIES["albedo"], order, screen_albedo(df, order), True)
    df = resolve_mass(df, order)
    df = pick(df, QUANTITIES["rotation_period"], order, screen_spin(df, order), True)
    if keep_work:
        return df
    return df.select(*[c for c in df.columns if not c.startswith("_") and "__" not in c and c not in absent])
