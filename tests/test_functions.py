import pytest
from pyspark.sql import functions as F

from orrery.functions import cleaning as cl
from orrery.functions import dims, keys
from orrery.functions import physics as P


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("(433) Eros", "433"), ("433 Eros", "433"), ("3.0", "3"), ("2011 FT9", "2011 FT9"), ("2011 ft9", "2011 FT9"),
        ("1999 AB0", "1999 AB"), ("4101 t-3", "4101 T-3"), ("007", "7"), ("000", "0"), ("nan", None), ("<NA>", None),
        ("", None), (" 12 ", "12"), ("(12) 2024 AB1", "12"), ("Ceres", "Ceres"), (None, None),
        ("( 1 ) Ceres", "1"), (" ( 1)", "1"), ("(1)Ceres", "1"), ("1987 Qc7", "1987 QC7"), ("8112 MARBLE", "8112"), (" 41.00", "41"),
        ("00041.0", "41"), ("1.5", "1.5"), ("12 Ab", "12"), ("\t7\n", "7"),
    ],
)
def test_canonical(spark, raw, want):
    assert one(spark, raw, keys.canonical) == want
    if want:
        assert one(spark, want, keys.canonical) == want


@pytest.mark.parametrize("packed, want", [("00433", "433"), ("A0345", "100345"), ("a0017", "360017"), ("~0001", "620001"), ("~0010", "620062"), ("J95X0", None), ("", None), (None, None)])
def test_unpack(spark, packed, want):
    assert one(spark, packed, keys.unpack_number) == want


def test_shapes_and_parentheses(spark):
    assert one(spark, " 1999 AB12 ", keys.looks_like_designation) is True
    assert one(spark, None, keys.looks_like_designation) is False
    assert one(spark, "Apophis (2004 MN4) ", keys.in_parentheses) == "2004 MN4"
    assert one(spark, "Apophis", keys.in_parentheses) is None


def test_numeric_and_flags(spark):
    assert one(spark, "abc", cl.numeric) is None
    assert one(spark, "1e3", cl.numeric) == 1000.0
    assert one(spark, float("nan"), cl.numeric, "double") is None
    assert one(spark, None, cl.flag) is False
    assert [one(spark, v, cl.stacked_flag) for v in ("Y", "1", "N", "", "x", None)] == [True, True, False, False, None, None]
    assert one(spark, [None, float("nan"), -1.0, 2.0], cl.first_positive, "array<double>") == 2.0
    assert one(spark, "sQ", cl.class_label) == "Sq"
    assert one(spark, "<NA>", cl.class_label) is None


def test_physics(spark):
    d = one(spark, 10.0, lambda c: P.diameter_from_mass(P.sphere_volume_m3(c) * 2000.0, F.lit(2.0)), "double")
    assert d == pytest.approx(10.0)
    assert one(spark, 0.0, lambda c: P.bulk_density(F.lit(1.0), c), "double") is None
    back = one(spark, 15.0, lambda h: P.implied_albedo(h, P.diameter_from_h(h, F.lit(0.2))), "double")
    assert back == pytest.approx(0.2)
    assert one(spark, 9.0, lambda d: P.spins_too_fast(F.lit(0.1), d, F.lit(5.0)), "double") is False
    assert one(spark, None, lambda d: P.spins_too_fast(F.lit(0.1), d, F.lit(5.0)), "double") is False


def test_masks(spark):
    df = spark.createDataFrame(
        [("DV--", 1.0, 0.1, 0.2, 0.0), ("-V", 1.0, 0.1, -0.2, 0.1), (None, 1.0, -0.1, 0.2, 0.1)],
        "fit_code string, diameter_km double, diameter_sigma_km double, albedo double, albedo_sigma double",
    )
    got = [tuple(r)[1:] for r in cl.mask_unfitted(df).collect()]
    assert got == [(1.0, 0.1, 0.2, None), (None, None, None, None), (None, None, 0.2, 0.1)]


def test_dims_are_consistent():
    known = {c for c, *_ in dims.class_rows()}
    assert len(known) == 33
    sums = {}
    for cls, grp, _, share in dims._rows(dims.SHARES):
        assert cls in known
        sums[cls, grp] = sums.get((cls, grp), 0) + share
    assert all(abs(v - 1) < 1e-9 for v in sums.values())
