"""Steps of the build whose cost must not grow faster than the tables."""

import os

import pytest
from pyspark.sql import functions as F

from orrery.functions import keys
from orrery.operators import distinct, skew
from orrery.operators.identity import rekey
from orrery.operators.pool import pool
from orrery.plans import fixtures

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("moved", [[], [("OLD1", "1"), ("7", "8"), ("NAME4", None)]])
def test_rows_stay_where_few_keys_move(spark, monkeypatch, moved):
    raw = ["old1", "7", "7.0", " 9 ", "(12) Best", "0", None, "nan", "Name4", "1950 ab0"] + [str(k) for k in range(100, 140)]
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(raw)], "designation string, n int")
    names = spark.createDataFrame(moved, "alias string, to_designation string")
    monkeypatch.setattr(distinct, "MAX_DISTINCT", 10)  # fewer than there are keys, more than move
    few = rekey(rows, names)
    assert "Exchange hashpartitioning" not in plan(few)
    monkeypatch.setattr(distinct, "MAX_DISTINCT", 0)
    assert few.columns == rows.columns and sorted(few.collect(), key=lambda r: r.n) == sorted(rekey(rows, names).collect(), key=lambda r: r.n)
    want = {r.n: r.c for r in rows.select("n", keys.canonical(F.col("designation")).alias("c")).collect()}
    known = {k: v for k, v in moved if v}
    assert {r.n: r.designation for r in few.collect()} == {n: known.get((c or "").upper(), c) for n, c in want.items()}


def test_keys_that_are_as_they_should_be(spark):
    kept = ["1950 AA", "2001 SQ12", "Ceres", "Name4", "NA", "2019 YZ3"]
    other = {"1950 aa": "1950 AA", "1950 AA0": "1950 AA", " Ceres\n": "Ceres", "Ceres\n": "Ceres", "nan": None, "None": None, "007": "7", "12.0": "12", "(3) Juno": "3", "4 Vesta": "4"}
    rows = spark.createDataFrame([(k, k) for k in kept] + list(other.items()), "raw string, want string")
    got = rows.select("raw", "want", keys.canonical(F.col("raw")).alias("got"), keys.number_or_text(F.col("raw")).alias("text"), F.col("raw").rlike(keys.AS_IT_IS).alias("fast")).collect()
    assert all(r.want == r.got for r in got), got
    assert all(r.text == r.raw for r in got if r.raw != "12.0") and {r.raw for r in got if r.fast} >= set(kept)


def test_texts_of_most_bodies_are_listed_once(spark, monkeypatch):
    texts = [None, "", "a", "b|a", "|c", "b", "a|"]
    rows = spark.range(400).select(
        (F.col("id") % 23).cast("string").alias("designation"), (F.col("id") % 5).cast("double").alias("diameter_sigma_km"),
        (F.col("id") % 7 * 1.5).alias("diameter_km"), *[F.array(*map(F.lit, texts))[(F.hash("id", F.lit(s)) % 7 + 7).cast("int") % 7].alias(s) for s in ("fit_code", "reference")],
    )
    rows = rows.unionByName(rows.where("designation = '3'").withColumns({"designation": F.lit("x"), "fit_code": F.lit(None).cast("string")}))
    make = lambda: pool(rows, [("diameter_km", "diameter_sigma_km")], texts=("reference", "fit_code"))
    monkeypatch.setattr(skew, "HOT_SHARE", 1)  # no key is hot
    cold = make()
    assert "Generate" not in plan(cold)
    monkeypatch.setattr(skew, "HOT_SHARE", 1_000_000)  # all are
    pick = lambda df: sorted(tuple(r) for r in df.select("designation", F.coalesce("reference", F.lit("-")), F.coalesce("fit_code", F.lit("-")), "n_fits").collect())
    assert pick(cold) == pick(make()) and cold.count() == 24


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_bodies_are_made_once(spark):
    plain, written = fixtures.views(spark, SF), fixtures.views(spark, SF, written=True)
    for name in ("fx_orbits", "fx_best", "fx_compendium", "fx_links"):
        assert not any("part.parquet" in f for f in written[name].inputFiles())
        assert plain[name].exceptAll(written[name]).isEmpty() and written[name].exceptAll(plain[name]).isEmpty()
