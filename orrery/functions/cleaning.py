"""Cleaning expressions. Missing is NULL, and NULL only: NaN ends at ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for "missing" in a key and in a class column.
MISSING_KEYS = ["", "nan", "NaN", "None", "none", "<NA>"]
MISSING_CLASSES = ["", "-", "nan", "NaN", "None", "none", "<NA>", "NA"]


def numeric(col: Column | str) -> Column:
    """A double; unparseable text and NaN become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def flag(col: Column | str) -> Column:
    """A boolean; NULL is false."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.try_cast("boolean"), F.lit(False))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def yes_no(c: Column) -> Column:
    """Y / True and N / False to boolean, anything else NULL."""
    return F.when(c.isin("Y", "True"), True).when(c.isin("N", "False"), False)


def stacked_flag(c: Column) -> Column:
    """Y or 1 is true; N, 0 or empty is false; anything else NULL."""
    return F.when(c.isin("Y", "1"), True).when(c.isin("N", "0", ""), False)


def symmetric_sigma(lo: Column, hi: Column) -> Column:
    """One sigma from an error pair: the mean of the absolute errors."""
    return (F.abs(lo) + F.abs(hi)) / 2


def first_positive(values: Column) -> Column:
    """First positive element of an array of doubles."""
    return F.get(F.filter(values, lambda x: F.coalesce(~F.isnan(x) & (x > 0), F.lit(False))), 0)


def fill_if_column_empty(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` for all rows if column ``name`` is absent or wholly NULL."""
    if name in df.columns and df.agg(F.count(name)).first()[0]:
        return df
    return df.withColumn(name, value)


def keep_unless(bad: Column, *names: str) -> dict[str, Column]:
    """The columns, NULL where ``bad`` is true."""
    fine = ~F.coalesce(bad, F.lit(False))
    return {n: F.when(fine, F.col(n)) for n in names}


def mask_sentinels(df: DataFrame) -> DataFrame:
    """Placeholders to NULL with their sigmas: H of 0 or from 90 up, and sizes,
    albedos and masses that are not positive."""
    h = F.col("absolute_magnitude_h")
    rules = [
        ((h == 0) | (h >= 90), ["absolute_magnitude_h", "absolute_magnitude_h_sigma"]),
        (F.col("diameter_km") <= 0, ["diameter_km", "diameter_sigma_km"]) if "diameter_km" in df.columns else None,
        (F.col("albedo") <= 0, ["albedo", "albedo_sigma"]) if "albedo" in df.columns else None,
        (F.col("estimated_mass_kg") <= 0, ["estimated_mass_kg", "estimated_mass_sigma_kg"])
        if "estimated_mass_kg" in df.columns
        else None,
    ]
    new: dict[str, Column] = {}
    for rule in rules:
        if rule:
            new |= keep_unless(rule[0], *[n for n in rule[1] if n in df.columns])
    return df.withColumns(new)


#: Slots of a fit code: letter at its place means that the quantity was fitted.
FIT_SLOTS = [
    ("D", "diameter_km", "diameter_sigma_km"),
    ("V", "albedo", "albedo_sigma"),
    ("B", "neowise_beaming_param", "neowise_beaming_param_sigma"),
    ("I", "albedo_ir", "albedo_ir_sigma"),
]


def mask_unfitted(df: DataFrame, code: str = "fit_code") -> DataFrame:
    """Blank quantities that a fit code says were assumed, then bad pairs.

    A negative value or sigma blanks both; a sigma of 0 blanks the sigma. A
    missing code blanks nothing, and without the column only pairs are judged.
    """
    new: dict[str, Column] = {}
    for k, (letter, value, sigma) in enumerate(FIT_SLOTS, 1):
        if value not in df.columns:
            continue
        slot = F.substring(F.rpad(F.col(code), 4, "-"), k, 1) if code in df.columns else F.lit(letter)
        bad = F.coalesce(slot != letter, F.lit(False)) | F.coalesce(F.col(value) < 0, F.lit(False))
        if sigma in df.columns:
            bad |= F.coalesce(F.col(sigma) < 0, F.lit(False))
            new[sigma] = F.when(~bad & (F.col(sigma) > 0), F.col(sigma))
        new[value] = F.when(~bad, F.col(value))
    return df.withColumns(new)


def tidy_text(c: Column) -> Column:
    """Stripped; empty becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def class_label(c: Column) -> Column:
    """A class name, stripped, first letter upper and the rest lower; markers of
    "missing" become NULL."""
    s = strip(c)
    cased = F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, F.lit(2), F.length(s))))
    return F.when(~s.isin(MISSING_CLASSES), cased)


def is_blank(c: Column, markers: list[str] | None = None) -> Column:
    """Missing, empty or white space, or one of ``markers``."""
    s = strip(c)
    return F.coalesce(s.isin(markers or [""]) | (s == ""), F.lit(True))


def joined_names(masks: dict[str, Column]) -> Column:
    """Names whose mask is set, joined by ``;``; NULL when none is."""
    return F.nullif(F.concat_ws(";", *[F.when(m, n) for n, m in masks.items()]), F.lit(""))


def any_of(masks: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, masks, F.lit(False))
