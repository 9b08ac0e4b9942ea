"""Physical relations as Column expressions; NULL where a divisor is zero."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
H_CONSTANT_KM = 1329.0
G_SI = 6.67430e-11
G_KM3 = 6.67430e-20
DAYS_PER_YEAR = 365.25
SPIN_LIMIT_KM = 10.0
ALBEDO_FLOOR, ALBEDO_CEILING = 0.01, 1.0
IMPLIED_FLOOR, IMPLIED_CEILING = 0.01 * 10**-0.3, 10**0.3
DENSITY_FLOOR, DENSITY_CEILING_ANY, DENSITY_CEILING_UNKNOWN = 0.25, 8.0, 5.0


def sphere_volume_m3(d_km: Column) -> Column:
    return F.lit(math.pi / 6) * F.pow(d_km * 1000.0, F.lit(3.0))


def bulk_density(mass_kg: Column, d_km: Column) -> Column:
    return F.try_divide(mass_kg, sphere_volume_m3(d_km)) / 1000.0


def diameter_from_mass(mass_kg: Column, rho: Column) -> Column:
    return F.cbrt(F.try_divide(6.0 * mass_kg, 1000.0 * rho) / math.pi) / 1000.0


def implied_albedo(h: Column, d_km: Column) -> Column:
    return F.pow(F.try_divide(F.lit(H_CONSTANT_KM), d_km) * F.pow(F.lit(10.0), -h / 5.0), F.lit(2.0))


def smallest_diameter(d_km: Column, h: Column) -> Column:
    """The diameter, else the size at an albedo of 1."""
    return F.when(d_km > 0, d_km).otherwise(H_CONSTANT_KM * F.pow(F.lit(10.0), -h / 5.0))


def min_period_h(rho: Column) -> Column:
    return F.sqrt(F.try_divide(F.lit(3.0 * math.pi), G_SI * 1000.0 * rho)) / 3600.0


def spins_too_fast(period_h: Column, d_km: Column, rho: Column) -> Column:
    return F.coalesce((d_km >= SPIN_LIMIT_KM) & (period_h < min_period_h(rho)), F.lit(False))


def diameter_from_h(h: Column, albedo: Column) -> Column:
    return F.try_divide(F.lit(H_CONSTANT_KM), F.sqrt(albedo)) * F.pow(F.lit(10.0), -h / 5.0)


def volume_equivalent(volume_km3: Column) -> Column:
    return F.cbrt(6.0 * volume_km3 / math.pi)


def volume_equivalent_sigma(volume_km3: Column, sigma_km3: Column) -> Column:
    return F.try_divide(volume_equivalent(volume_km3) * sigma_km3, 3.0 * volume_km3)


def days_to_years(days: Column) -> Column:
    return days / DAYS_PER_YEAR


def mass_from_gm(gm_km3: Column) -> Column:
    """Kilograms from GM in km3/s2; only a positive GM has a mass."""
    return F.when(gm_km3 > 0, gm_km3 / G_KM3)
