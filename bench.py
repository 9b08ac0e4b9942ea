"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import dims
from orrery.operators import resolve
from orrery.plans import catalog, fixtures, queries
from orrery.plans.staging import staged

#: Queries that do their own work, one per family of operators.
HEADLINES = ["c01_canonical", "d02_rekey", "e04_pool_fits", "e01_combine_duplicates", "v10_suspects", "e13_albedo_by_class"]
#: Bodies of the full catalog, to which the validated table is replicated.
FULL = 1_555_667


def replicated(valid: DataFrame) -> DataFrame:
    """The validated table at the size of the full catalog, under keys of its own."""
    times = -(-FULL // max(1, valid.count()))
    copies = valid.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).limit(FULL)
    return copies.withColumn("designation", F.concat_ws("-", "designation", "copy")).drop("copy")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"/tmp/checkpoints/{uuid.uuid4().hex}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def run(name, make) -> None:
        began = time.time()
        make().write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
        print(name, took[name], file=sys.stderr, flush=True)

    # The whole build, from landed views to the gated table.
    run("catalog_build", lambda: catalog.build(fixtures.views(spark, sf), spark, "2026-01-01").table)
    # Each step of the build, from the written table of the step before.
    at = lambda name: queries.stage(spark, sf, name)
    for name in ("merged", "resolved", "derived", "valid", "enriched"):
        at(name)
    run("stage_merge", lambda: catalog.merged(fixtures.views(spark, sf), spark))
    run("stage_resolve", lambda: resolve.resolve(at("merged"), catalog.ORDER, dims.density_limits(spark)))
    run("stage_derive", lambda: catalog.derived(at("resolved"), spark))
    run("stage_enrich", lambda: catalog.enriched(at("valid"), spark))
    full = staged(replicated(at("valid")).repartition(2 * int(cpus)), "full-catalog")
    for name in ("enrich_1555667_bodies_cold", "enrich_1555667_bodies"):
        run(name, lambda: catalog.enriched(full, spark))
    for name in HEADLINES:
        run(name, lambda n=name: queries.QUERIES[n](spark, sf))
    try:
        from orrery.llm.queries import QUERIES
    except ImportError:
        QUERIES = {}
    for name, make in QUERIES.items():
        run(name, lambda f=make: f(spark, sf))
    total = sum(took.values())
    print(json.dumps({"metric": "headline_queries_total", "value": round(total, 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
