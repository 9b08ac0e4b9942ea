"""References behind imported properties: cards joined to bodies, a row per property."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Catalog column, property of the card, key of its value.
PROPERTIES = [
    ("estimated_mass_kg", "mass", "value"),
    ("density_gcm3", "density", "value"),
    ("diameter_km", "diameter", "value"),
    ("absolute_magnitude_h", "absolute_magnitude", "H"),
    ("spectral_type", "taxonomy", "class"),
]
RELATIVE = 1e-6
_BIB = "bibref: array<struct<shortbib: string, bibcode: string, doi: string>>"
CARD_SCHEMA = (
    "id string, number long, ssocard struct<version: string, datetime: string>, "
    "parameters struct<physical: struct<"
    + ", ".join(f"{p}: struct<{k}: {'string' if k == 'class' else 'double'}, {_BIB}>" for _, p, k in PROPERTIES)
    + ">>"
)


def join_cards(bodies: DataFrame, cards: DataFrame) -> DataFrame:
    """Each body's card: by id, and where there is none by number."""
    cols = [c for c in cards.columns if c not in ("id", "number")]
    card = F.struct(*cols)
    by_id = cards.where("id is not null").groupBy(F.col("id").alias("ssodnet_id")).agg(F.min_by(card, F.coalesce("number", F.lit(0))).alias("_by_id"))
    by_no = cards.where("number is not null").groupBy(F.col("number").cast("string").alias("designation")).agg(F.min_by(card, F.coalesce("id", F.lit(""))).alias("_by_no"))
    out = bodies.join(by_id, "ssodnet_id", "left").join(by_no, "designation", "left")
    return out.withColumn("card", F.coalesce("_by_id", "_by_no")).drop("_by_id", "_by_no")


def property_rows(joined: DataFrame) -> DataFrame:
    """(designation, property, value, card_value, status, shortbib, bibcode, doi).

    One row per imported property that the body has. Status: no card, no value,
    no reference, differs or matches.
    """
    entries: list[Column] = []
    for col, prop, key in PROPERTIES:
        node = F.col(f"card.parameters.physical.{prop}")
        value, own = F.col(col), node[key]
        if key == "class":
            same = F.trim(own) == F.trim(value)
        else:
            same = F.abs(own - value) <= RELATIVE * F.greatest(F.abs(own), F.abs(value))
        bib = F.coalesce(node["bibref"], F.array().cast(_BIB.split(": ", 1)[1]))
        status = (
            F.when(F.col("card").isNull(), "no card").when(own.isNull(), "no value")
            .when(F.size(bib) == 0, "no reference").when(~same, "differs").otherwise("matches")
        )
        join = lambda f, bib=bib: F.array_join(F.transform(bib, lambda b: b[f]), ";")
        entries.append(
            F.when(
                value.isNotNull(),
                F.struct(
                    F.lit(prop).alias("property"), value.cast("string").alias("value"), own.cast("string").alias("card_value"),
                    status.alias("status"), join("shortbib").alias("shortbib"), join("bibcode").alias("bibcode"), join("doi").alias("doi"),
                ),
            )
        )
    return joined.select("designation", F.explode(F.array_compact(F.array(*entries))).alias("p")).select("designation", "p.*")


def summary(rows: DataFrame) -> DataFrame:
    """(status, n_rows, n_bodies)."""
    return rows.groupBy("status").agg(F.count("*").alias("n_rows"), F.count_distinct("designation").alias("n_bodies"))
