"""Readers of landed files and writers of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.cleaning import conform, tidy_text


class MissingColumn(Exception):
    """A column without which a source is useless."""


def wanted_columns(df: DataFrame, wanted: dict[str, str], required: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, renamed, and the names of those that do not.

    If a required one is missing the table comes back empty.
    """
    missing = [c for c in wanted if c not in df.columns]
    out = df.select(*[F.col(f"`{c}`").alias(to) for c, to in wanted.items() if c in df.columns])
    return (out.where(F.lit(False)) if set(required) & set(missing) else out), missing


def delimited(spark: SparkSession, path: str, schema: T.StructType, first_column: str) -> DataFrame:
    """CSV with a header whose first column must be the one expected."""
    head = spark.read.text(path).first()
    if head is None or head[0].split(",")[0].strip().strip('"') != first_column:
        raise MissingColumn(f"the header of {path} does not begin with {first_column}")
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def top_n(df: DataFrame, n: int, *by: str) -> DataFrame:
    """The first rows in a total order, nulls last; 0 is no limit."""
    order = [F.col(c).asc_nulls_last() for c in by]
    return df.orderBy(*order, F.xxhash64(*df.columns)).limit(n) if n else df


def joined_best(best: DataFrame, bodies: DataFrame, on: str, texts: tuple[str, ...] = ()) -> DataFrame:
    """Best values of a source that keeps bodies and measurements in two tables,
    joined on the source's own id; blank ``texts`` become NULL."""
    return best.withColumns({c: tidy_text(F.col(c)) for c in texts}).join(bodies, on)


def nested_cards(spark: SparkSession, path: str, schema: str, wanted: dict[str, str]) -> DataFrame:
    """Cards landed as JSON lines: the ``wanted`` nested fields under flat names.

    The schema is explicit, so no pass infers it, and a card that lacks a field has
    NULL there.
    """
    cards = spark.read.schema(schema).json(path)
    return cards.select(*[F.col(field).alias(name) for field, name in wanted.items()])


LINK_SCHEMA = "Number string, Name string, Principal_desig string, Other_desigs array<string>"


def link_pairs(objects: DataFrame) -> DataFrame:
    """(alias, to_designation) of identity objects: the number if there is one,
    else the principal designation."""
    number = F.regexp_replace(F.trim("Number"), r"^\((.*)\)$", "$1")
    to = F.coalesce(F.nullif(number, F.lit("")), F.nullif(F.trim("Principal_desig"), F.lit("")))
    others = F.coalesce("Other_desigs", F.array().cast("array<string>"))
    aliases = F.concat(F.array("Principal_desig", "Name"), others)
    pairs = objects.select(F.explode(F.array_compact(aliases)).alias("alias"), to.alias("to_designation"))
    return pairs.where("to_designation is not null and trim(alias) <> ''")


def identity_links(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return link_pairs(spark.read.schema(LINK_SCHEMA).option("multiLine", multiline).json(path))


def catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A catalog CSV; ids are text whatever they look like."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    flat = df.withColumns({f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))})
    flat.write.options(header=True, lineSep="\r\n").csv(path)


def write_typed(df: DataFrame, schema: T.StructType, path: str) -> None:
    conform(df, schema).write.option("compression", "zstd").parquet(path)


def build_info(sources: dict[str, DataFrame], **extra: str) -> DataFrame:
    """One row per source with its row count, and constants of the build."""
    out = None
    for name, df in sources.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out.withColumns({k: F.lit(v) for k, v in extra.items()})
