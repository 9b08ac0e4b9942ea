"""Survivorship: duplicates combined into one row, records kept whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.keys import comparison_key
from orrery.operators.counts import Watch
from orrery.plans.staging import staged

#: Keys that several rows hold, up to which they are broadcast.
MAX_SHARED = 500_000


def combine_duplicates(
    df: DataFrame, key: str = "designation", records: list[list[str]] | None = None, ties: tuple[str, ...] = (), loose: list[list[str]] | None = None
) -> DataFrame:
    """One row per entity, each column from the fullest row that has it.

    Rows are grouped by the comparison key of ``key``; rows without a key are
    dropped. ``records`` lists column groups that travel together: all columns of
    a group come from the row that gave the group's first column, even if NULL
    there. So do those of a group in ``loose``, but where no row has its first column
    each is filled on its own. Ties between equally full rows go to the smaller key, then to the
    smaller ``ties``, then to a hash of all columns, so the result does not depend
    on partitioning.
    """
    records, loose = records or [], loose or []
    bound = {c for r in records for c in r}
    full = sum([F.col(c).isNotNull().cast("int") for c in df.columns], F.lit(0))
    order = F.struct((-full).alias("f"), F.col(key).alias("k"), *ties, F.xxhash64(*df.columns).alias("x"))
    keyed = df.withColumns({"_key": comparison_key(F.col(key)), "_order": order}).where("_key is not null")

    def best(value: Column, lead: str) -> Column:
        return F.min_by(F.struct(value.alias("v")), F.when(F.col(lead).isNotNull(), F.col("_order")))["v"]

    aggs = [best(F.col(c), c).alias(c) for c in df.columns if c not in bound]
    aggs += [best(F.struct(*r), r[0]).alias(f"_r{k}") for k, r in enumerate(records + loose)]
    where = {c: F.col(f"_r{k}.{c}") for k, r in enumerate(records) for c in r}
    where |= {c: F.when(F.col(f"_r{k}").isNull(), F.col(c)).otherwise(F.col(f"_r{k}.{c}")) for k, r in enumerate(loose, len(records)) for c in r}
    return keyed.groupBy("_key").agg(*aggs).select(*[where.get(c, F.col(c)).alias(c) for c in df.columns])


def combine_shared(
    df: DataFrame, key: str = "designation", records: list[list[str]] | None = None, watch: Watch | None = None, name: str = "dedup", loose: list[list[str]] | None = None
) -> DataFrame:
    """``combine_duplicates`` of a table in which few rows share an entity.

    Only the rows whose comparison key another row has are combined; the others,
    and rows without a key, pass through untouched. Keys alone are shuffled to
    find out, and where none is shared the table is returned as it is. The shared keys
    are broadcast up to MAX_SHARED. A ``watch`` counts rows in and out on the way.
    """
    keyed = df.withColumn("_key", comparison_key(F.col(key)))
    counts = keyed.groupBy("_key").agg(F.count("*").alias("n"))
    if watch is not None:
        counts = watch.on(counts, name, rows_in=F.sum("n"), rows_out=F.sum(F.when(F.col("_key").isNull(), F.col("n")).otherwise(1)))
    shared = staged(counts.where("_key is not null and n > 1").select("_key"), "shared-keys")
    many = shared.count()
    if not many:
        return df
    few = F.broadcast(shared) if many <= MAX_SHARED else shared
    alone = keyed.join(few, "_key", "left_anti").select(*df.columns)
    several = keyed.join(few, "_key", "left_semi").select(*df.columns)
    return alone.unionByName(combine_duplicates(several, key, records, loose=loose))


def adopt_whole(records: list[tuple[str, Column, list[str]]], required: list[str]) -> Column:
    """The record an entity ends with, of (source, struct, fields) in precedence order.

    The first complete record (all ``required`` fields), else the first that has
    any field; fields it lacks stay NULL. The result has a ``provider`` field.
    """

    def tagged(name: str, rec: Column, fields: list[str]) -> Column:
        return F.struct(*[rec[f].alias(f) for f in fields], F.lit(name).alias("provider"))

    complete, some = [], []
    for name, rec, fields in records:
        has_all = F.lit(set(required) <= set(fields))
        for f in set(required) & set(fields):
            has_all &= rec[f].isNotNull()
        has_any = F.lit(False)
        for f in fields:
            has_any |= rec[f].isNotNull()
        complete.append(F.when(has_all, tagged(name, rec, fields)))
        some.append(F.when(has_any, tagged(name, rec, fields)))
    return F.coalesce(*complete, *some)


def combine_counted(
    df: DataFrame, source: str, policy: str = "warn", key: str = "designation", records: list[list[str]] | None = None, ties: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """``combine_duplicates``, written, and (source, rows_in, rows_out, alarm) of it.

    Both counts are taken while the result is written. It is an alarm if rows went in
    and none came out, which ``policy`` ignores, warns of or refuses.
    """
    spark, watch = df.sparkSession, Watch(policy)
    before = watch.on(df, "in", n=F.count(F.lit(1)))
    out = staged(watch.on(combine_duplicates(before, key, records, ties), "out", n=F.count(F.lit(1))), "combined")
    rows_in, rows_out = watch.counts("in")["n"], watch.counts("out")["n"]
    alarm = rows_in > 0 and rows_out == 0
    watch.judge([f"{source}: {rows_in} rows went in and none came out"] if alarm else [])
    return out, spark.createDataFrame([(source, rows_in, rows_out, alarm)], "source string, rows_in long, rows_out long, alarm boolean")
