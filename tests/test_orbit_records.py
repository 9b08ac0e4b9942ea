"""Rows of one source that share a body do not mix their orbits."""

from orrery.plans import catalog

COLUMNS = "designation string, semi_major_axis_au double, mean_anomaly_deg double, element_epoch_jd double, x double"
FIELDS = ("designation", "semi_major_axis_au", "mean_anomaly_deg", "element_epoch_jd", "x")


def combined(spark, data):
    df = spark.createDataFrame(data, COLUMNS)
    got = [{tuple(r[c] for c in FIELDS) for r in catalog._dedup(d).collect()} for d in (df, df.repartition(3), df.orderBy("x"))]
    assert got[0] == got[1] == got[2]
    return got[0]


def test_an_orbit_comes_from_one_row(spark):
    # The fuller row of 7 has no mean anomaly, and is not lent the other's; of 8 the fuller row has no orbit.
    data = [("7", 1.0, None, 1.0, 1.0), ("7.0", 2.0, 99.0, None, None), ("8", None, 5.0, 3.0, 4.0), ("8.0", 2.5, None, 6.0, None), ("9", 3.0, 1.0, 2.0, None)]
    assert combined(spark, data) == {("7", 1.0, None, 1.0, 1.0), ("8", 2.5, None, 6.0, 4.0), ("9", 3.0, 1.0, 2.0, None)}


def test_an_orbit_without_axis_is_filled(spark):
    assert combined(spark, [("7", None, None, 1.0, 1.0), ("7.0", None, 99.0, None, None)]) == {("7", None, 99.0, 1.0, 1.0)}
