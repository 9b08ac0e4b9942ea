"""Phase fractions per class, from small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import dims
from orrery.functions.numbers import number_text


def typed_fractions(spark: SparkSession) -> DataFrame:
    """(class, phase, fraction) of every class with shares of its own."""
    coarse = dims.classes(spark).select(
        "class", F.stack(F.lit(4), F.lit("metal"), "metal", F.lit("silicate"), "silicate", F.lit("carbon"), "carbon", F.lit("ice"), "ice").alias("grp", "coarse")
    )
    parts = dims.shares(spark).join(coarse, ["class", "grp"]).select("class", "phase", (F.col("coarse") * F.col("share")).alias("fraction"))
    both = parts.unionByName(dims.accessories(spark))
    return both.where("fraction > 0").groupBy("class", "phase").agg(F.sum("fraction").alias("fraction"))


def member_masses(spark: SparkSession) -> DataFrame:
    """(class, member, mass): members of a mixed class by count x density."""
    density = dims.classes(spark).select(F.col("class").alias("member"), "density")
    return dims.x_counts(spark).join(density, "member").select("class", "member", (F.col("n") * F.col("density")).alias("mass"))


def mixture_fractions(spark: SparkSession) -> DataFrame:
    """Phase fractions of X and Xc: their members' shares of each group, scaled to
    the class's own coarse fractions; accessories are the members', by mass."""
    mass = member_masses(spark)
    total = mass.groupBy("class").agg(F.sum("mass").alias("total"))
    own = typed_fractions(spark).select(F.col("class").alias("member"), "phase", "fraction")
    mixed = (
        mass.join(own, "member").join(total, "class")
        .groupBy("class", "phase").agg(F.sum(F.col("mass") * F.col("fraction") / F.col("total")).alias("mixed"))
        .join(dims.phases(spark).select("phase", "grp"), "phase")
    )
    sums = mixed.groupBy("class", "grp").agg(F.sum("mixed").alias("group_sum"))
    coarse = dims.classes(spark).select(
        "class", F.stack(F.lit(4), F.lit("metal"), "metal", F.lit("silicate"), "silicate", F.lit("carbon"), "carbon", F.lit("ice"), "ice").alias("grp", "coarse")
    )
    joined = mixed.join(sums, ["class", "grp"]).join(coarse, ["class", "grp"], "left")
    value = F.when(F.col("grp") == "accessory", F.col("mixed")).otherwise(F.col("coarse") * F.col("mixed") / F.col("group_sum"))
    return joined.select("class", "phase", value.alias("fraction")).where("fraction > 0")


def phase_fractions(spark: SparkSession) -> DataFrame:
    """(class, phase, fraction) of every class; Unknown has none."""
    return typed_fractions(spark).unionByName(mixture_fractions(spark))


def detailed_fractions(spark: SparkSession) -> DataFrame:
    """Phase fractions with each phase divided into its finer ones."""
    typed, fine = typed_fractions(spark), dims.refinements(spark)
    extra = dims.refined_accessories(spark)
    # How a mixed class divides a phase: its members' divisions, by parent mass.
    mass = member_masses(spark)
    brought = mass.join(typed.withColumnRenamed("class", "member"), "member").withColumn("w", F.col("mass") * F.col("fraction"))
    member_fine = fine.select(F.col("class").alias("member"), "phase", "finer", "share")
    into = brought.join(member_fine, ["member", "phase"], "left").select(
        "class", "phase", F.coalesce("finer", "phase").alias("finer"), (F.col("w") * F.coalesce("share", F.lit(1.0))).alias("v")
    )
    den = brought.groupBy("class", "phase").agg(F.sum("w").alias("den"))
    mixed_fine = into.groupBy("class", "phase", "finer").agg(F.sum("v").alias("v")).join(den, ["class", "phase"]).select(
        "class", "phase", "finer", (F.col("v") / F.col("den")).alias("share")
    )
    total = mass.groupBy("class").agg(F.sum("mass").alias("total"))
    mixed_extra = (
        mass.join(extra.withColumnRenamed("class", "member"), "member").join(total, "class")
        .groupBy("class", "phase").agg(F.sum(F.col("mass") * F.col("fraction") / F.col("total")).alias("fraction"))
    )
    split = phase_fractions(spark).join(fine.unionByName(mixed_fine), ["class", "phase"], "left").select(
        "class", F.coalesce("finer", "phase").alias("phase"), (F.col("fraction") * F.coalesce("share", F.lit(1.0))).alias("fraction")
    )
    both = split.unionByName(extra).unionByName(mixed_extra)
    return both.where("fraction > 0").groupBy("class", "phase").agg(F.sum("fraction").alias("fraction"))


def as_json(fractions: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """(class, name): the phases of a class as a JSON object, in table order."""
    placed = fractions.join(dims.phases(spark).select("phase", "place"), "phase")
    pair = F.concat(F.lit('"'), "phase", F.lit('":'), number_text(F.col("fraction")))
    entries = F.array_sort(F.collect_list(F.struct("place", pair.alias("text"))))
    return placed.groupBy("class").agg(F.concat(F.lit("{"), F.array_join(entries["text"], ","), F.lit("}")).alias(name))


def phase_texts(spark: SparkSession) -> DataFrame:
    """(comp_class, comp_phases, comp_phases_detailed, comp_minerals): both tables as JSON
    text, and the names of the phases, largest group first, in table order."""
    coarse, fine = phase_fractions(spark), detailed_fractions(spark)
    placed = coarse.join(dims.phases(spark).select("phase", "place"), "phase")
    names = placed.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("place", "phase")))["phase"].alias("comp_minerals"))
    texts = as_json(coarse, spark, "comp_phases").join(as_json(fine, spark, "comp_phases_detailed"), "class").join(names, "class")
    return texts.withColumnRenamed("class", "comp_class")
