"""Queries about the fits themselves read every row of them."""

import os

import pytest
from pyspark.sql import functions as F

from orrery.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def got(spark, name):
    return queries.QUERIES[name](spark, SF)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


@pytest.fixture(scope="module")
def bodies(lines):
    return lines.select("l_partkey").distinct().count()


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_source_registry_counts_every_body_with_fits(spark, bodies):
    assert {r["source"]: r["n_rows"] for r in got(spark, "a09_source_registry").collect()}["fits"] == bodies


def test_flags_of_all_fits_are_decoded(spark, lines):
    assert total(got(spark, "b04_flag_decoding"), "n") == lines.count()


def test_codes_of_all_fits_are_read(spark, lines, bodies):
    codes = got(spark, "b10_fit_codes")
    assert total(codes, "n") == lines.count() and codes.select("designation").distinct().count() == bodies


@pytest.mark.parametrize("name", ["c01_canonical", "c02_comparison_key", "c03_shape"])
def test_keys_of_all_fits_are_read(spark, lines, name):
    key = (F.col("l_partkey") + 1).cast("string")
    raw = F.when(F.col("l_linenumber") % 7 == 1, F.concat(key, F.lit(".0"))).otherwise(key).alias("raw")
    assert lines.select(raw).join(got(spark, name), "raw", "left_anti").isEmpty()


def test_fits_of_all_bodies_are_pooled(spark, bodies):
    assert got(spark, "e04_pool_fits").count() == bodies


def test_all_fits_are_summed(spark, lines, bodies):
    sums = got(spark, "e07_any_and_sum")
    assert sums.count() == bodies and total(sums, "n_fits") == lines.count()
