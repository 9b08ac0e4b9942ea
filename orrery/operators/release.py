"""The publish gate, from one scan of the table, and publication that is all or nothing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.audit import physical_rules

#: Floors and shrink limits of a release; parameters of the gate.
ROW_FLOOR, MEASURED_FLOOR = 1_500_000, 135_000
MAX_SHRINK_ROWS, MAX_SHRINK_SOURCE = 0.005, 0.02
#: Columns that must hold one value in all rows.
STAMPS = ("catalog_date", "pipeline_version")
MANIFEST = (
    "tag string, catalog_date string, version string, n_rows long, n_measured long, n_rejected long, n_columns int, "
    "sources map<string,long>, columns array<string>"
)


class ReleaseRefused(Exception):
    """Raised before anything is written; holds every failed gate."""


class ReleaseExists(Exception):
    """A release is never overwritten."""


@dataclass(frozen=True)
class Fact:
    """How many rows state it, how many different texts, how many of these more than
    once, and the least."""

    n: int = 0
    different: int = 0
    repeated: int = 0
    least: str | None = None


def facts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(kind, name, n, different, repeated, least): all that a gate asks, in one scan.

    Each row states its facts: that it is there, its key, its stamps, its sources, the
    rules that it breaks. Facts are counted. Keys and stamps, of which there may be
    many, are then summed up by kind, so that a few dozen rows remain.
    """
    fact = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    none = F.lit("")
    own = [
        fact("row", none),
        F.when(F.col("diameter_source") == "measured", fact("measured", none)),
        F.when(F.col("designation").isNull(), fact("null key", none)).otherwise(fact("key", F.col("designation"))),
    ]
    own += [F.when(F.col(c).isNotNull(), fact(c, F.col(c).cast("string"))) for c in STAMPS]
    own += [F.when(F.coalesce(bad, F.lit(False)), fact("rule", F.lit(n))) for n, bad in rules]
    listed = F.coalesce(F.split("sources", ";"), F.array().cast("array<string>"))
    sources = F.transform(listed, lambda s: fact("source", s))
    each = df.select(F.explode(F.concat(F.array_compact(F.array(*own)), sources)).alias("f")).select("f.kind", "f.text")
    counted = each.groupBy("kind", "text").agg(F.count("*").alias("n"))
    name = F.when(~F.col("kind").isin("key", *STAMPS), F.col("text"))
    return counted.groupBy("kind", name.alias("name")).agg(
        F.sum("n").alias("n"), F.count("*").alias("different"), F.count_if(F.col("n") > 1).alias("repeated"), F.min("text").alias("least")
    )


class Found:
    """The facts of a table, in memory: a row per rule, source, stamp and total."""

    def __init__(self, table: DataFrame):
        self._facts = {(r["kind"], r["name"]): Fact(r["n"], r["different"], r["repeated"], r["least"]) for r in table.collect()}

    def of(self, kind: str, name: str | None = "") -> Fact:
        return self._facts.get((kind, name), Fact())

    def named(self, kind: str) -> dict[str, int]:
        return {name: f.n for (k, name), f in self._facts.items() if k == kind}


def gate(
    df: DataFrame,
    version: str,
    floors: dict[str, int],
    row_floor: int = ROW_FLOOR,
    measured_floor: int = MEASURED_FLOOR,
    previous: dict | None = None,
    allow_shrink: bool = False,
) -> tuple[list[str], Found]:
    """Every gate that fails, and the facts; a table without failures may be published.

    ``floors`` holds the least number of rows per source. ``previous`` is the manifest of
    the last release (see ``previous``), against which rows and sources may shrink by a
    little only.
    """
    found = Found(facts(df, physical_rules(df.columns)))
    rows, sources = found.of("row").n, found.named("source")
    date, own = (found.of(c, None) for c in STAMPS)
    checks = [
        ("too few rows", rows < row_floor),
        ("null keys", found.of("null key").n > 0),
        ("duplicate keys", found.of("key", None).repeated > 0),
        ("several catalog dates", date.different != 1),
        ("several versions", own.different != 1),
        ("unexpected version", own.least != version),
        ("too few measured diameters", found.of("measured").n < measured_floor),
    ]
    checks += [(f"too few rows from {s}", sources.get(s, 0) < least) for s, least in floors.items()]
    if previous and not allow_shrink:
        checks.append(("fewer rows than before", rows < previous["n_rows"] * (1 - MAX_SHRINK_ROWS)))
        before = previous["sources"] or {}
        checks += [(f"fewer rows from {s} than before", sources.get(s, 0) < n * (1 - MAX_SHRINK_SOURCE)) for s, n in before.items()]
    return [n for n, bad in checks if bad] + sorted(found.named("rule")), found


def problems_table(spark: SparkSession, problems: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in problems], "problem string")


def _store(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def previous(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the last release under ``root`` by date and tag, None if there is
    none. Releases that were not finished have no manifest at their place."""
    store, path = _store(spark, root)
    if not store.exists(path(root)):
        return None
    done = [str(s.getPath()) for s in store.listStatus(path(root)) if not s.getPath().getName().startswith("_")]
    done = [d for d in done if store.exists(path(f"{d}/manifest"))]
    if not done:
        return None
    last = spark.read.schema(MANIFEST).json([f"{d}/manifest" for d in done]).orderBy(F.desc("catalog_date"), F.desc("tag")).first()
    return last.asDict(recursive=True)


def publish(df: DataFrame, log: DataFrame, root: str, tag: str, problems: list[str], found: Found) -> DataFrame:
    """Write catalog, rejection log and manifest under ``root``/``tag``, or nothing.

    Everything is written to a hidden folder, the manifest last, which is then renamed.
    A failure on the way leaves no release; the hidden folder is removed. Returns the
    manifest.
    """
    if problems:
        raise ReleaseRefused("; ".join(sorted(problems)))
    spark = df.sparkSession
    store, path = _store(spark, root)
    place, hidden = path(f"{root}/{tag}"), f"{root}/_{uuid.uuid4().hex}"
    if store.exists(place):
        raise ReleaseExists(f"{root}/{tag}")
    try:
        df.write.option("compression", "zstd").parquet(f"{hidden}/catalog")
        log.write.parquet(f"{hidden}/rejections")
        rejected = log.agg(F.sum("rejected_count")).first()[0] or 0
        row = (
            tag, found.of(STAMPS[0], None).least, found.of(STAMPS[1], None).least, found.of("row").n, found.of("measured").n,
            int(rejected), len(df.columns), found.named("source"), df.columns,
        )
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.json(f"{hidden}/manifest")
        if not store.rename(path(hidden), place):
            raise ReleaseExists(f"{root}/{tag}")
    except BaseException:
        store.delete(path(hidden), True)
        raise
    return spark.read.schema(MANIFEST).json(f"{root}/{tag}/manifest")
