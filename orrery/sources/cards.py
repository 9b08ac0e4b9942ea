"""Nested cards whose shape drifts: read as VARIANT, with a report of what went missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How a path of a card can turn out.
FOUND, MISSING, OTHER, BROKEN = "found", "missing", "other type", "no card"


def cards(spark: SparkSession, path: str) -> DataFrame:
    """(card, raw): one row per line; ``card`` is a VARIANT, NULL where the line is no JSON,
    which ``raw`` then holds."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    card = F.try_parse_json("value")
    return lines.select(card.alias("card"), F.when(card.isNull(), F.col("value")).alias("raw"))


def _value(path: str, kind: str) -> Column:
    return F.try_variant_get("card", path, kind)


def flat(found: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """The ``wanted`` columns, name to (path, type), of every card.

    Every card gives a row, whatever its shape: a path that it lacks, or whose value is
    of another type, is NULL. ``card`` and ``raw`` stay, so nothing unknown is lost.
    """
    return found.select(*[_value(p, k).alias(n) for n, (p, k) in wanted.items()], "card", "raw")


def outcome(path: str, kind: str) -> Column:
    """How ``path`` turned out in a card. A JSON null counts as missing."""
    there = F.try_variant_get("card", path, "variant")
    return (
        F.when(F.col("card").isNull(), BROKEN)
        .when(there.isNull() | F.is_variant_null(there), MISSING)
        .when(_value(path, kind).isNull(), OTHER)
        .otherwise(FOUND)
    )


def drift(found: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """(name, path, outcome, n): how many cards each wanted path turned out how in, from
    one scan. A path that is found in no card has no row ``found``."""
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("path"), outcome(p, k).alias("outcome")) for n, (p, k) in wanted.items()])
    rows = found.select(F.explode(each).alias("x")).select("x.*")
    return rows.groupBy("name", "path", "outcome").agg(F.count("*").alias("n"))


def unknown_keys(found: DataFrame, known: list[str]) -> DataFrame:
    """(key, n): keys at the top of cards that are not ``known``, and in how many cards."""
    top = F.map_keys(F.try_variant_get("card", "$", "map<string,variant>"))
    keys = found.select(F.explode(top).alias("key"))
    return keys.where(~F.col("key").isin(known)).groupBy("key").agg(F.count("*").alias("n"))
