"""Columnar JSON cut into ranges anywhere, and doubles as text."""

import json
import pickle
import random
import struct

import pytest
from pyspark.sql import functions as F

from orrery.functions.numbers import number_text
from orrery.sources import columnar

ODD = ['a"b', "c\\", '\\"', "[[", "]]}", '"fields": [', "é日本", "x,[1]", "", "{", "\\\\\"", "tab\there"]


def payload(fields, data, **kw):
    return json.dumps({"signature": {"v": [1, [2, [3]]]}, "fields": fields, "data": data, "count": len(data)}, **kw)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_ranges_may_cut_anywhere(spark, tmp_path, size):
    rng = random.Random(size)
    data = [[str(k), rng.choice(ODD), rng.choice([None, 1, 2.50, True, "-1e5"])] for k in range(60 if size > 7 else 12)]
    (tmp_path / "a.json").write_text(payload([{"name": "id"}, "x", "y"], data, indent=rng.choice([None, 1])))
    (tmp_path / "b.json").write_text(payload(["z", "id"], [[ODD[5], "b1"], [None, "b2"]], ensure_ascii=False))
    (tmp_path / "_hidden").write_text("{")
    got = columnar.columnar_json(spark, str(tmp_path), {"y": "why"}, range_bytes=size)
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    want = [(a, b, text(c), None) for a, b, c in data] + [("b1", None, None, ODD[5]), ("b2", None, None, None)]
    assert got.columns == ["id", "x", "why", "z"] and rows(got) == sorted(want, key=str)


def test_a_large_payload_is_read_by_many_tasks(spark, tmp_path):
    n = 60_000
    (tmp_path / "one.json").write_text(payload(["id", "v"], [[k, f"value {k}"] for k in range(n)]))
    got = columnar.columnar_json(spark, str(tmp_path / "one.json"), {"id": "key"}, ("key",), range_bytes=200_000)
    tasks = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(tasks) >= 6 and sum(tasks) == n
    assert got.agg(F.sum("key")).first()[0] == n * (n - 1) / 2


def test_short_payloads_share_tasks_and_no_task_gets_all_ranges(spark, tmp_path):
    for k in range(200):
        (tmp_path / f"{k:03d}.json").write_text(payload(["id", "v"] if k % 2 else ["v", "id"], [[str(k), str(-k)]]))
    got = columnar.columnar_json(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() <= 2 * columnar.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert rows(got) == sorted([(str(k), str(-k)) if k % 2 == 0 else (str(-k), str(k)) for k in range(200)], key=str)
    tasks = [[[f"file {k}", 0, 1, False, 0, 0, 0]] for k in range(1000)]
    reader = columnar._Reader({"ranges": json.dumps([[["id"]], tasks])}, ["id"])
    assert len(reader.partitions()) == 1000 and len(pickle.dumps(reader)) < 500


def test_fields_may_come_last_and_must_come(spark, tmp_path):
    (tmp_path / "late.json").write_text('{"data": [["\\"fields\\": [", 1]], "other": {"fields": ["no"]}, "fields": ["a", "b"]}')
    assert rows(columnar.columnar_json(spark, str(tmp_path / "late.json"), range_bytes=16)) == [('"fields": [', "1")]
    (tmp_path / "none.json").write_text('{"data": [[1]]}')
    with pytest.raises(columnar.BadPayload, match="no fields"):
        columnar.columnar_json(spark, str(tmp_path / "none.json"))
    (tmp_path / "empty.json").write_text('{"fields": ["a"], "data": []}')
    assert rows(columnar.columnar_json(spark, str(tmp_path / "empty.json"))) == []


def test_number_text_is_the_shortest_that_reads_back(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -2.5, 1e-7, 1e-4, 9.999e-5, 123456789.0, 1e15, 1e16, 1.5e16, 0.1 + 0.2, 1 / 3, 5e-324, 1.7976931348623157e308, 2.0**53, 1e22, 1e23, 100.0]
    values += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(500)] + [rng.random() for _ in range(500)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(number_text(F.col("v"))).collect()]
    assert [float(t) for t in got] == values
    wrong = [(t, repr(v)) for t, v in zip(got, values) if t != repr(v)]
    assert not wrong, wrong[:5]
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("-inf"),)], "v double").select(number_text(F.col("v"))).collect()
    assert [r[0] for r in odd] == [None, "NaN", "-Infinity"]
