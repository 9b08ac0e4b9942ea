"""The publish gate in one scan, and publication that is all or nothing."""

import os

import pytest
from pyspark.sql import functions as F

from orrery.operators import release, validate

SCHEMA = "designation string, diameter_km double, diameter_source string, sources string, catalog_date string, pipeline_version string"


def table(spark, n, date="2026-01-01", sources="a;b"):
    return spark.createDataFrame([(str(k), 1.0, "measured", sources if k % 2 else "a", date, "1.0") for k in range(n)], SCHEMA)


def log(spark):
    return spark.createDataFrame([("r", 3, ["x"])], validate.LOG_SCHEMA)


def publish(spark, root, df, tag, **kw):
    problems, found = release.gate(df, "1.0", {}, 1, 1, **kw)
    return release.publish(df, log(spark), root, tag, problems, found)


def test_gate_names_every_failure(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", 1.0, "measured", "a", "d", "1.0"), ("1", float("inf"), "none", "a", "e", "2.0"), (None, 1.0, None, None, None, None)], SCHEMA
    )
    problems, found = release.gate(df, "1.0", {"a": 5, "z": 1}, row_floor=5, measured_floor=2)
    assert problems == [
        "too few rows", "null keys", "duplicate keys", "several catalog dates", "several versions", "too few measured diameters",
        "too few rows from a", "too few rows from z", "diameter_km is not finite",
    ]
    assert found.named("source") == {"a": 2} and found.of("key", None) == release.Fact(2, 1, 1, "1")
    root = str(tmp_path / "out")
    with pytest.raises(release.ReleaseRefused, match="duplicate keys"):
        release.publish(df, log(spark), root, "t", problems, found)
    assert not os.path.exists(root)
    assert "unexpected version" in release.gate(table(spark, 3), "9", {}, 1, 1)[0]


def test_the_gate_scans_its_table_once(spark):
    df = table(spark, 40).withColumn("x", F.lit(1))
    plan = release.facts(df, [("r", F.col("diameter_km") > 0)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1


def test_a_release_may_shrink_by_a_little_only(spark, tmp_path):
    root = str(tmp_path / "out")
    assert release.previous(spark, root) is None
    out = publish(spark, root, table(spark, 1000), "2026-01-01").first()
    assert (out["n_rows"], out["n_measured"], out["n_rejected"], out["sources"]) == (1000, 1000, 3, {"a": 1000, "b": 500})
    before = release.previous(spark, root)
    assert before["tag"] == "2026-01-01" and before["columns"] == SCHEMA.replace(" double", "").replace(" string", "").split(", ")
    gate = lambda df, **kw: release.gate(df, "1.0", {}, 1, 1, previous=before, **kw)[0]
    assert gate(table(spark, 995)) == []
    assert gate(table(spark, 994)) == ["fewer rows than before"]
    assert gate(table(spark, 1000, sources="a")) == ["fewer rows from b than before"]
    assert gate(table(spark, 10), allow_shrink=True) == []
    # The last release counts, whatever was written first.
    publish(spark, root, table(spark, 990, "2026-02-01"), "2026-02-01", allow_shrink=True)
    publish(spark, root, table(spark, 3, "2025-12-01"), "2025-12-01")
    assert release.previous(spark, root)["n_rows"] == 990


def test_a_failure_on_the_way_leaves_no_release(spark, tmp_path):
    root = str(tmp_path / "out")
    df = table(spark, 5)
    publish(spark, root, df, "one")
    bad = log(spark).withColumn("rejected_count", F.expr("assert_true(false)").cast("long"))
    problems, found = release.gate(df, "1.0", {}, 1, 1)
    with pytest.raises(Exception, match="false"):
        release.publish(df, bad, root, "two", problems, found)
    assert sorted(os.listdir(root)) == ["one"] and release.previous(spark, root)["tag"] == "one"
    with pytest.raises(release.ReleaseExists):
        publish(spark, root, df, "one")
    os.makedirs(f"{root}/three/catalog")  # begun by something else, never finished
    assert release.previous(spark, root)["tag"] == "one"
    assert spark.read.parquet(f"{root}/one/catalog").count() == 5
