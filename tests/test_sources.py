"""Delimited files that filter where they are read, and cards whose shape drifts."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.sources import cards, delimited
from orrery.sources.readers import MissingColumn

SCHEMA = "k long, t string, x double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def landed(tmp_path):
    rng = random.Random(1)
    data = [(k, rng.choice(["a", "b b", "", 'q"q', "c,c"]), rng.choice([None, 1.5, -2.0, k / 7])) for k in range(400)]
    rng.shuffle(data)
    cell = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"' if isinstance(v, str) and v else str(v)
    for part in (0, 1):
        lines = ["k,unused,t,x"] + [",".join([str(k), "zz", cell(t), cell(x)]) for k, t, x in data[part::2]]
        (tmp_path / f"{part}.csv").write_text("\r\n".join(lines) + ("\r\n" if part else ""))
    return str(tmp_path), [(k, t or None, x) for k, t, x in data]


@pytest.mark.parametrize("size", [11, 100, 1 << 20])
def test_ranges_and_filters_give_the_same_rows(spark, landed, size, monkeypatch):
    path, data = landed
    schema = spark.createDataFrame([], SCHEMA).schema
    df = delimited.delimited_first(spark, path, schema, "k", range_bytes=size * 20 if size < 100 else size)
    assert rows(df) == sorted(data, key=str)
    cases = [
        (F.col("t") != "a", lambda k, t, x: t is not None and t != "a"),
        (F.col("x").isNull(), lambda k, t, x: x is None),
        ((F.col("x") >= 1.5) & (F.col("k") < 300), lambda k, t, x: x is not None and x >= 1.5 and k < 300),
        (~F.col("t").isin("a", "c,c"), lambda k, t, x: t is not None and t not in ("a", "c,c")),
        (F.length("t") > 1, lambda k, t, x: t is not None and len(t) > 1),
    ]
    for condition, keep in cases:
        assert rows(df.where(condition)) == sorted((r for r in data if keep(*r)), key=str)


def test_filter_and_first_rows_reach_the_scan(spark, landed):
    path, data = landed
    schema = spark.createDataFrame([], SCHEMA).schema
    df = delimited.delimited_first(spark, path, schema, "k", 5, ("x", "k"), range_bytes=2000)
    kept = df.where((F.col("t") != "a") & F.col("x").isNotNull())
    ranges = df.rdd.getNumPartitions()
    assert ranges > 4 and kept.count() <= 5 * ranges < len(data)
    assert "Filter" not in kept._jdf.queryExecution().optimizedPlan().toString().split("RelationV2")[0]
    want = sorted((r for r in data if r[1] not in (None, "a") and r[2] is not None), key=lambda r: (r[2], r[0]))[:5]
    assert [tuple(r) for r in delimited.first_rows(kept, 5, ("x", "k")).collect()] == want
    # A filter that is not pushed turns the cut off, so no row is missed.
    late = df.where(F.length("t") > 2)
    want = sorted((r for r in data if r[1] and len(r[1]) > 2), key=lambda r: (r[2] is None, r[2], r[0]))[:5]
    assert [tuple(r) for r in delimited.first_rows(late, 5, ("x", "k")).collect()] == want


def test_headers_are_checked(spark, landed):
    path, _ = landed
    with pytest.raises(MissingColumn, match="does not begin with t"):
        delimited.delimited_first(spark, path, spark.createDataFrame([], SCHEMA).schema, "t")
    with pytest.raises(MissingColumn, match="has no gone"):
        delimited.delimited_first(spark, path, spark.createDataFrame([], "k long, gone string").schema, "k")


def test_cards_of_unknown_shape_are_kept_and_reported(spark, tmp_path):
    lines = ['{"id": 1, "p": {"mass": {"value": 2.5}}}', '{"id": 2, "p": {"mass": 7}}', '{"id": 3, "q": [1]}', "[1, 2]", '{"id": ', '{"id": 4, "p": {"mass": {"value": "big"}}}', "", '{"id": 5, "p": {"mass": {"value": null}}}']
    (tmp_path / "cards.json").write_text("\n".join(lines))
    found = cards.cards(spark, str(tmp_path / "cards.json"))
    wanted = {"id": ("$.id", "long"), "mass": ("$.p.mass.value", "double")}
    got = cards.flat(found, wanted).select("id", "mass", F.to_json("card").alias("card"), "raw")
    assert got.count() == 7
    assert {(r["id"], r["mass"]) for r in got.collect() if r["id"]} == {(1, 2.5), (2, None), (3, None), (4, None), (5, None)}
    assert [r["raw"] for r in got.where("raw is not null").collect()] == ['{"id": ']
    report = {(r["name"], r["outcome"]): r["n"] for r in cards.drift(found, wanted).collect()}
    assert report == {("id", "found"): 5, ("id", "missing"): 1, ("id", "no card"): 1, ("mass", "found"): 1, ("mass", "missing"): 4, ("mass", "other type"): 1, ("mass", "no card"): 1}
    assert rows(cards.unknown_keys(found, ["id", "p"])) == [("q", 1)]
