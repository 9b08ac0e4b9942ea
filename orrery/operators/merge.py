"""Precedence merge of keyed sources into one wide table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions import physics
from orrery.functions.cleaning import joined_names
from orrery.operators.counts import Watch
from orrery.operators.survivor import adopt_whole
from orrery.plans.staging import staged

#: Measured volumes up to which they are broadcast.
MAX_VOLUMES = 500_000


@dataclass
class SourceSpec:
    """A source by name; its place in the list is its precedence."""

    name: str
    df: DataFrame
    enabled: bool = True
    limit: int = 0
    order_by: str = "designation"
    floor: int = 0
    notes: dict[str, str] = field(default_factory=dict)


def active(sources: list[SourceSpec]) -> list[SourceSpec]:
    """Sources that are switched on and not empty, capped where asked."""
    out = []
    for s in sources:
        if s.enabled and not s.df.isEmpty():
            df = s.df
            if s.limit:
                df = df.orderBy(F.col(s.order_by).asc_nulls_last(), F.xxhash64(*df.columns)).limit(s.limit)
            out.append(SourceSpec(s.name, df, s.enabled, s.limit, s.order_by, s.floor, s.notes))
    return out


def merge(
    sources: list[SourceSpec],
    held: set[str],
    key: str = "designation",
    whole: tuple[str, ...] = (),
    required: tuple[str, ...] = (),
    watch: Watch | None = None,
) -> DataFrame:
    """One row per key over all sources, by one aggregation of their tagged union.

    Each row of a source travels as one struct, so every source is shuffled once,
    however many there are, and the wide table is not. Of rows of one source that share
    a key, which the steps before leave none of, the largest struct counts.

    Columns in ``held`` stay apart as ``<column>__<source>`` for later resolution;
    for others the first source in precedence that has a value gives it. Columns in
    ``whole`` are one record: all come from the first source with every one of
    ``required``, else from the first with any, and ``orbit_provider`` names it.
    ``source_<name>`` flags say which sources hold the key; ``n_sources`` and
    ``sources`` sum these up. Precedence is in the coalesce order alone. With a
    ``watch`` the overlap of each source with those before it is counted in flight.
    """
    out = _grouped(sources, key)
    if watch is not None:
        out = watch.on(out, "overlap", **_overlap_counts([s.name for s in sources]))
    order: list[str] = []
    for s in sources:
        order += [c for c in s.df.columns if c != key and c not in order]
    record = [c for c in order if c in whole]
    plain = [
        F.coalesce(*[F.col(f"{c}__{s.name}") for s in sources if c in s.df.columns]).alias(c)
        for c in order
        if c not in held and c not in record
    ]
    if record:
        kinds = {c: next(s.df.schema[c].dataType for s in sources if c in s.df.columns) for c in record}

        def of(s: SourceSpec) -> Column:
            values = [(F.col(f"{c}__{s.name}") if c in s.df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in record]
            return F.struct(*values)

        owners = [(s.name, of(s), record) for s in sources if set(record) & set(s.df.columns)]
        out = out.withColumn("_record", adopt_whole(owners, list(required)))
        plain += [F.col(f"_record.{c}").alias(c) for c in record] + [F.col("_record.provider").alias("orbit_provider")]
    apart = [F.col(f"{c}__{s.name}") for c in order if c in held for s in sources if c in s.df.columns]
    present = {s.name: F.coalesce(F.col(f"source_{s.name}"), F.lit(False)) for s in sources}
    return out.select(
        key,
        *plain,
        *apart,
        *[m.alias(f"source_{n}") for n, m in present.items()],
        sum([m.cast("long") for m in present.values()], F.lit(0).cast("long")).alias("n_sources"),
        joined_names(present).alias("sources"),
    )


def _grouped(sources: list[SourceSpec], key: str) -> DataFrame:
    """One row per key: ``<column>__<source>`` and ``source_<source>`` of every source."""

    def record(s: SourceSpec) -> Column:
        return F.struct(F.lit(True).alias("held"), *[F.col(f"`{c}`") for c in s.df.columns if c != key])

    kinds = {s.name: s.df.select(record(s).alias("r")).schema["r"].dataType for s in sources}
    parts = []
    for s in sources:
        cols = [(record(t) if t is s else F.lit(None).cast(kinds[t.name])).alias(f"_of_{t.name}") for t in sources]
        parts.append(s.df.where(F.col(key).isNotNull()).select(key, *cols))
    each = reduce(DataFrame.union, parts).groupBy(key).agg(*[F.max(f"_of_{s.name}").alias(f"_of_{s.name}") for s in sources])
    flat = [F.col(f"_of_{s.name}.`{c}`").alias(f"{c}__{s.name}") for s in sources for c in s.df.columns if c != key]
    return each.select(key, *flat, *[F.col(f"_of_{s.name}.held").alias(f"source_{s.name}") for s in sources])


def _overlap_counts(names: list[str]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for k, n in enumerate(names[1:], 1):
        here = F.col(f"source_{n}").isNotNull()
        before = F.coalesce(*[F.col(f"source_{m}") for m in names[:k]]).isNotNull()
        out[f"overlap_{k}"], out[f"new_{k}"] = F.count_if(here & before), F.count_if(here & ~before)
    return out


def overlap_of(watch: Watch, sources: list[SourceSpec]) -> list[tuple[str, int, int, bool]]:
    """(source, overlap, new_rows, alarm) of each supplement against those before it, as
    counted while the merged table was written; an empty source is no alarm."""
    seen = watch.counts("overlap")
    pairs = [(s.name, seen[f"overlap_{k}"], seen[f"new_{k}"]) for k, s in enumerate(sources[1:], 1)]
    return [(n, both, new, both == 0 and new > 0) for n, both, new in pairs]


def judge_overlap(watch: Watch, sources: list[SourceSpec]) -> None:
    """What the watch's policy says of sources whose keys meet none of those before."""
    watch.judge([f"{n} matches no key of the sources before it: all of its {new} rows are new" for n, _, new, alarm in overlap_of(watch, sources) if alarm])


def overlap_report(sources: list[SourceSpec], key: str = "designation", policy: str = "ignore") -> DataFrame:
    """(source, overlap, new_rows, alarm) of each supplement against those before it, by
    a merge of the keys alone."""
    spark, watch = sources[0].df.sparkSession, Watch(policy)
    only = [SourceSpec(s.name, s.df.select(key)) for s in sources]
    staged(watch.on(_grouped(only, key), "overlap", **_overlap_counts([s.name for s in only])), "keys")
    judge_overlap(watch, only)
    return spark.createDataFrame(overlap_of(watch, only), "source string, overlap long, new_rows long, alarm boolean")


def override_diameters(df: DataFrame, volumes: DataFrame, label: str = "shape model") -> DataFrame:
    """Bodies with a measured volume take its equivalent diameter and sigma."""
    shape = volumes.select(
        "designation",
        physics.volume_equivalent(F.col("volume_km3")).alias("_d"),
        physics.volume_equivalent_sigma(F.col("volume_km3"), F.col("volume_sigma_km3")).alias("_s"),
    )
    hit = F.col("_d").isNotNull()
    new = {
        "diameter_km": F.coalesce("_d", "diameter_km"),
        "diameter_sigma_km": F.when(hit, F.col("_s")).otherwise(F.col("diameter_sigma_km")),
        "diameter_provider": F.when(hit, label).otherwise(F.col("diameter_provider")),
    }
    few = volumes.limit(MAX_VOLUMES + 1).count() <= MAX_VOLUMES
    return df.join(F.broadcast(shape) if few else shape, "designation", "left").withColumns(new).drop("_d", "_s")


def column_order(df: DataFrame, backbone: list[str], measured: dict[str, list[str]]) -> DataFrame:
    """Backbone columns first, each measured value followed by its companions."""
    order: list[str] = []
    for c in [*backbone, *df.columns]:
        if c in df.columns and c not in order and not any(c in m for m in measured.values()):
            order.append(c)
            order += [m for m in measured.get(c, []) if m in df.columns and m not in order]
    order += [c for c in df.columns if c not in order]
    return df.select(*order)
