"""Entity resolution: alias maps and re-keying onto a backbone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.keys import canonical, comparison_key, matched_form, number_or_text
from orrery.operators import distinct
from orrery.plans.staging import staged

NAMES = ["designation", "provisional_designation", "name"]


def unambiguous(pairs: DataFrame) -> DataFrame:
    """(alias, to_designation) where the alias names one entity only."""
    return (
        pairs.where("alias is not null and to_designation is not null")
        .groupBy("alias")
        .agg(F.min("to_designation").alias("to_designation"), F.max("to_designation").alias("hi"))
        .where("to_designation = hi")
        .drop("hi")
    )


def alias_map(backbone: DataFrame) -> DataFrame:
    """Comparison keys of every name of the backbone's entities."""
    to = canonical(F.col("designation")).alias("to_designation")
    parts = [backbone.select(comparison_key(F.col(n)).alias("alias"), to) for n in NAMES if n in backbone.columns]
    return unambiguous(reduce(DataFrame.unionByName, parts))


def link_map(links: DataFrame) -> DataFrame:
    """Links (alias, to_designation) keyed for comparison, unambiguous only."""
    return unambiguous(
        links.select(comparison_key(F.col("alias")).alias("alias"), canonical(F.col("to_designation")).alias("to_designation"))
    )


def name_map(aliases: DataFrame, links: DataFrame) -> DataFrame:
    """(alias, to_designation) of aliases and links in one table.

    An alias goes before a link of the same name; what a link leads to goes through the
    aliases again.
    """
    hop = link_map(links).withColumn("_to", comparison_key(F.col("to_designation")))
    again = aliases.select(F.col("alias").alias("_to"), F.col("to_designation").alias("_again"))
    linked = hop.join(again, "_to", "left").select("alias", F.coalesce("_again", "to_designation").alias("_linked"))
    both = aliases.join(linked, "alias", "full")
    return both.select("alias", F.coalesce("to_designation", "_linked").alias("to_designation"))


def rekey(df: DataFrame, aliases: DataFrame, links: DataFrame | None = None, key: str = "designation") -> DataFrame:
    """``df`` with ``key`` moved onto the backbone; nothing is dropped.

    A key is looked up among the aliases, then among the links. An unmatched key becomes
    its canonical form. Rules and look-ups run once per distinct key, not per row. Up to
    ``distinct.MAX_DISTINCT`` keys that end otherwise than as the number or text that they
    are get broadcast; then no row is shuffled, however many other keys there are.
    """
    names = aliases if links is None else name_map(aliases, links)
    keys = df.groupBy(key).agg(F.count("*").alias("_rows")).withColumn("_canon", canonical(F.col(key)))
    known = names.select(F.col("alias").alias("_k"), F.col("to_designation").alias("_known"))
    found = keys.withColumn("_k", matched_form(F.col("_canon"))).join(known, "_k", "left")
    out = F.coalesce("_known", "_canon")
    moved = ~out.eqNullSafe(number_or_text(F.col(key)))
    results = staged(found.select(key, "_rows", out.alias(f"_out_{key}"), moved.alias("_moved")), "keys")
    many = results.agg(F.count_if("_moved")).first()[0]
    if not many:
        return df.withColumn(key, number_or_text(F.col(key)))
    if many > distinct.MAX_DISTINCT:
        return distinct.brought_back(df, results, [key], [key])
    few = F.broadcast(results.where("_moved").select(F.col(key).alias("_in"), F.col(f"_out_{key}").alias("_to"), "_moved"))
    both = df.join(few, F.col(key).eqNullSafe(F.col("_in")), "left")
    new = F.when(F.col("_moved"), F.col("_to")).otherwise(number_or_text(F.col(key)))
    return both.select(*[new.alias(c) if c == key else F.col(c) for c in df.columns])
