import json
import math
import statistics

import pytest
from pyspark.sql import functions as F

from orrery.functions import dims
from orrery.operators import audit, calibrate, classify, counts, distinct, identity, impute, lookup, merge, minerals, pool, quantile, resolve, skew, survivor, validate
from orrery.plans import staging
from orrery.sources import readers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_alias_map_leaves_ambiguous_names_out(spark):
    b = spark.createDataFrame([("1", "2020 AB", "Ceres"), ("2", "2020 AC", "Twin"), ("3", None, "twin")], "designation string, provisional_designation string, name string")
    got = dict(rows(identity.alias_map(b), "alias", "to_designation"))
    assert got["CERES"] == "1" and got["2020 AB"] == "1" and "TWIN" not in got


def test_rekey_two_hops_and_nothing_lost(spark):
    b = spark.createDataFrame([("1", "2020 AB", "Ceres")], "designation string, provisional_designation string, name string")
    links = spark.createDataFrame([("1900 XY", "2020 AB"), ("1901 ZA", "77")], "alias string, to_designation string")
    df = spark.createDataFrame([("ceres", 1), ("1900 xy", 2), ("1901 ZA", 3), ("unknown", 4), (None, 5)], "designation string, k int")
    got = dict((k, d) for d, k in rows(identity.rekey(df, identity.alias_map(b), links), "designation", "k"))
    assert got == {1: "1", 2: "1", 3: "77", 4: "unknown", 5: None}


def test_pool_weights(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 1.0), ("a", 12.0, 1.0), ("a", 14.0, 1.0), ("b", 5.0, None), ("c", 1.0, None), ("c", 3.0, None), ("d", 1.0, 1.0), ("d", 9.0, None)],
        "designation string, diameter_km double, diameter_sigma_km double",
    )
    got = {k: (v, s) for k, v, s in rows(pool.pool(df, [("diameter_km", "diameter_sigma_km")]), "designation", "diameter_km", "diameter_sigma_km")}
    assert got["a"] == (pytest.approx(12.0), pytest.approx(math.sqrt(8 / 3)))
    assert got["b"] == (5.0, None)
    assert got["c"] == (pytest.approx(2.0), pytest.approx(1.0))
    assert got["d"][0] == pytest.approx(1.0)


def test_combine_is_independent_of_partitioning_and_idempotent(spark):
    data = [("7.0", 1.0, None, "x"), ("7", None, 0.1, None), ("(7) Name", 2.0, 0.2, "y"), (None, 9.0, 9.0, "z")]
    df = spark.createDataFrame(data, "designation string, diameter_km double, diameter_sigma_km double, t string")
    rec = [["diameter_km", "diameter_sigma_km"]]
    a = survivor.combine_duplicates(df, records=rec)
    b = survivor.combine_duplicates(df.repartition(3).orderBy(F.desc("t")), records=rec)
    assert rows(a, *df.columns) == rows(b, *df.columns) == rows(survivor.combine_duplicates(a, records=rec), *df.columns)
    assert rows(a, "diameter_km", "diameter_sigma_km") == [(2.0, 0.2)]


def test_sigma_is_not_lent(spark):
    df = spark.createDataFrame([("7", 1.0, None, "x", 1), ("7", None, 0.1, None, None)], "designation string, diameter_km double, diameter_sigma_km double, t string, n int")
    got = survivor.combine_duplicates(df, records=[["diameter_km", "diameter_sigma_km"]])
    assert rows(got, "diameter_km", "diameter_sigma_km") == [(1.0, None)]


def test_merge_equals_union_and_group(spark):
    a = spark.createDataFrame([("1", 1.0, None), ("2", None, "b")], "designation string, x double, t string")
    b = spark.createDataFrame([("2", 5.0, "c"), ("3", 6.0, None)], "designation string, x double, t string")
    got = merge.merge([merge.SourceSpec("a", a), merge.SourceSpec("b", b)], set())
    assert rows(got, "designation", "x", "t", "n_sources", "sources") == [
        ("1", 1.0, None, 1, "a"), ("2", 5.0, "b", 2, "a;b"), ("3", 6.0, None, 1, "b")
    ]
    u = a.withColumn("r", F.lit(0)).unionByName(b.withColumn("r", F.lit(1)))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("r"))).alias(c)
    assert rows(u.groupBy("designation").agg(first("x"), first("t")), "designation", "x", "t") == rows(got, "designation", "x", "t")


def _wide(spark, **cols):
    names = list(cols)
    schema = ", ".join(f"{n} {'string' if n in ('designation', 'grp') else 'double'}" for n in names)
    return spark.createDataFrame([tuple(cols.values())], schema)


def test_conflict_vote_drops_the_diameter(spark):
    df = _wide(spark, designation="a", grp="Unknown", diameter_km__x=20.0, estimated_mass_kg__x=4e18, estimated_mass_kg__best=4.1e18)
    r = resolve.resolve(df, ["x", "best"], dims.density_limits(spark)).first()
    assert r["diameter_km"] is None and r["diameter_screened_out"] == "x" and r["estimated_mass_kg"] == 4.1e18
    tie = _wide(spark, designation="a", grp="Unknown", diameter_km__x=20.0, estimated_mass_kg__x=4e18)
    r = resolve.resolve(tie, ["x"], dims.density_limits(spark)).first()
    assert r["diameter_km"] == 20.0 and r["estimated_mass_kg"] is None and r["mass_screened_out"] == "x"


def test_screened_values_still_count(spark):
    df = _wide(spark, designation="a", grp="Unknown", albedo__x=1.5, albedo__y=0.2, albedo__z=float("inf"))
    r = resolve.resolve(df, ["x", "y", "z"], dims.density_limits(spark)).first()
    assert (r["albedo"], r["albedo_provider"], r["albedo_n_sources"], r["albedo_screened_out"]) == (0.2, "y", 2, "x;z")
    assert r["albedo_spread"] == pytest.approx(6.5) and r["albedo_sources_agree"] is False


def test_mass_takes_its_own_diameter(spark):
    v = math.pi / 6 * 1e15
    df = _wide(spark, designation="a", grp="Unknown", diameter_km__x=90.0, diameter_km__best=100.0, estimated_mass_kg__best=2000.0 * v)
    r = resolve.resolve(df, ["x", "best"], dims.density_limits(spark)).first()
    assert (r["diameter_km"], r["diameter_provider"], r["mass_provider"]) == (100.0, "best", "best")


def test_whole_record_adoption(spark):
    df = spark.createDataFrame([((1.0, None), (2.0, 2.0)), ((None, None), (3.0, None)), ((1.0, 1.0), (2.0, 2.0)), ((None, None), (None, None))], "a struct<x:double,y:double>, b struct<x:double,y:double>")
    rec = survivor.adopt_whole([("a", F.col("a"), ["x", "y"]), ("b", F.col("b"), ["x", "y"])], ["x", "y"])
    got = [r["o"] and tuple(r["o"]) for r in df.select(rec.alias("o")).collect()]
    assert got == [(2.0, 2.0, "b"), (3.0, None, "b"), (1.0, 1.0, "a"), None]


BODY = "designation string, diameter_km double, absolute_magnitude_h double, albedo double, semi_major_axis_au double, is_neo boolean, spectral_type string, spectral_type_tholen string"


def test_albedo_cascade_and_bands(spark):
    df = spark.createDataFrame(
        [("a", None, 15.0, 0.3, 2.2, False, None, None), ("b", None, 15.0, 1.5, 2.2, False, "Sq", None), ("c", None, 15.0, None, 2.2, True, "-", None),
         ("d", None, 2.9, None, 40.0, False, None, None), ("e", None, 15.0, None, None, False, None, None), ("f", 3.0, 15.0, None, 2.5, False, None, None), ("g", None, None, None, 2.5, False, None, None)],
        BODY,
    )
    got = {r["designation"]: r for r in impute.derive_diameters(df, spark).collect()}
    assert [got[k]["albedo_assumed_for_diameter"] for k in "abcde"] == [0.3, 0.244, 0.137, 0.4481, 0.078]
    assert got["f"]["diameter_source"] == "measured" and got["g"]["diameter_source"] == "none"


def test_validation_counts_first_failure(spark):
    df = spark.createDataFrame([("1", 1.0, 2.0), (None, None, 2.0), ("3", float("inf"), None), ("4", 1.0, -1.0), ("5", None, None)], "designation string, diameter_km double, semi_major_axis_au double")
    kept, log = validate.split(df, validate.row_rules(df.columns))
    assert rows(kept, "designation") == [("1",)]
    assert dict(rows(log, "reason", "rejected_count")) == {"missing designation": 1, "non-finite diameter": 1, "missing or non-positive diameter": 1, "missing or non-positive semi-major axis": 1}


MEASURED = BODY + ", estimated_mass_kg double, estimated_mass_sigma_kg double, density_gcm3 double, mass_provider string, mass_screened_out string, derived_diameter_is_estimate boolean, diameter_source string, albedo_assumed_for_diameter double"


def test_every_row_is_mass_density_volume(spark):
    ball = math.pi / 6 * 1e9  # m3 of a sphere of 1 km
    df = spark.createDataFrame(
        [("a", 10.0, 12.0, 0.2, 2.2, False, "S", None, None, None, None, None, None, False, "measured", None),
         ("b", 10.0, 12.0, 0.2, 2.2, False, "S", None, None, None, 9.0, None, None, False, "measured", None),
         # 2.7 g/cm3 and 90 km at H 9: a surface of albedo 0.0548 is possible
         ("c", 20.0, 9.0, None, 2.2, False, "S", None, 2700 * ball * 90**3, 1e17, None, "x", None, True, "derived_h_x", 0.2),
         # 900 km at H 9 would be blacker than anything: the mass goes
         ("e", 20.0, 9.0, None, 2.2, False, "S", None, 2700 * ball * 900**3, 1e17, None, "x", "y", True, "derived_h_x", 0.2),
         # an estimate that agrees with its mass stays
         ("f", 20.0, 9.0, None, 2.2, False, "S", None, 2000 * ball * 20**3, 1e15, None, "x", None, True, "derived_h_x", 0.2),
         ("d", 90.0, 9.0, None, 2.2, False, "X", None, 1e18, 1e17, None, "x", None, False, "measured", None)],
        MEASURED,
    )
    out = classify.reconcile(classify.add_composition(classify.classify(df), spark))
    got = {r["designation"]: r for r in out.collect()}
    for r in got.values():
        assert r["estimated_mass_kg"] == pytest.approx(r["density_gcm3"] * 1e3 * math.pi / 6 * (r["diameter_km"] * 1e3) ** 3)
    assert got["b"]["density_gcm3"] == 2.7 and got["d"]["mass_measured"]
    c, e, f = got["c"], got["e"], got["f"]
    assert (c["diameter_source"], c["mass_provider"], c["albedo_assumed_for_diameter"]) == ("derived_mass", "x", None)
    assert c["diameter_km"] == pytest.approx(90.0) and c["density_gcm3"] == pytest.approx(2.7) and c["mass_measured"]
    assert (e["diameter_source"], e["diameter_km"], e["mass_provider"], e["mass_screened_out"]) == ("derived_h_x", 20.0, None, "y;x")
    assert (e["estimated_mass_sigma_kg"], e["mass_measured"], e["density_gcm3"]) == (None, False, 2.7)
    assert (f["diameter_source"], f["diameter_km"], f["mass_measured"], f["density_measured"]) == ("derived_h_x", 20.0, True, False)
    assert f["density_gcm3"] == pytest.approx(2.0)
    assert not audit.violations(out, audit.physical_rules(out.columns)).where("rule like 'mass is not%'").count()


def test_composition_brings_phases(spark):
    df = spark.createDataFrame([("1", 9.0, 9.0, p, 2.2, False, c, None) for p, c in ((0.2, "S"), (None, "X"), (0.2, "Xc"), (0.2, "?"))], BODY)
    out = classify.add_composition(classify.classify(df.withColumn("albedo_assumed_for_diameter", F.lit(None).cast("double"))), spark)
    got = {r["comp_class"]: r for r in out.collect()}
    assert set(got) == {"S", "X", "M", "Unknown"}
    assert got["Unknown"]["comp_phases"] is None and got["Unknown"]["comp_minerals"] is None
    for cls in ("S", "X", "M"):
        assert list(json.loads(got[cls]["comp_phases"])) == got[cls]["comp_minerals"]
        assert sum(json.loads(got[cls]["comp_phases_detailed"]).values()) == pytest.approx(sum(json.loads(got[cls]["comp_phases"]).values()), abs=0.02)


@pytest.mark.parametrize("axis, row, group", [(39.4, "D", "D-type"), (5.5, "S", "S-complex"), (None, "S", "S-complex")])
def test_a_far_body_is_composed_as_d(spark, axis, row, group):
    df = spark.createDataFrame([("28978", 709.6, 3.8, 0.2, axis, False, "S", None)], BODY)
    out = classify.add_composition(classify.classify(df.withColumn("albedo_assumed_for_diameter", F.lit(None).cast("double"))), spark).first()
    density = {r["class"]: r["density"] for r in dims.classes(spark).collect()}
    assert (out["spectral_type"], out["comp_class"], out["comp_group"], out["_limits_group"]) == ("S", row, group, group)
    assert out["comp_density_est_gcm3"] == density[row]


def test_far_x_types_are_not_split(spark):
    df = spark.createDataFrame([("1", 100.0, 5.0, 0.2, 40.0, False, "X", None)], BODY)
    out = classify.add_composition(classify.classify(df.withColumn("albedo_assumed_for_diameter", F.lit(None).cast("double"))), spark).first()
    assert out["comp_class"] == "D"


@pytest.mark.parametrize("few", [10_000, 3])
def test_medians_are_exact(spark, few):
    values = {"a": [5.0], "b": [1.0, 2.0], "c": [3.0] * 50 + [9.0], "d": [float(k * k % 97) for k in range(200)], "e": [-1e9, 0.5, 1e9, None]}
    rows_ = [(g, v) for g, vs in values.items() for v in vs] + [(None, 4.0), ("f", None)]
    df = spark.createDataFrame(rows_, "g string, v double").repartition(3)
    got = {r["g"]: (r["median"], r["n"]) for r in quantile.exact_medians(df, ["g"], "v", few).collect()}
    have = {g: [v for v in vs if v is not None] for g, vs in values.items()}
    assert got == {**{g: (statistics.median(v), len(v)) for g, v in have.items()}, None: (4.0, 1)}


def test_a_rule_that_most_rows_break(spark):
    df = spark.range(50_000).select(F.format_string("%06d", "id").alias("designation"), F.when(F.col("id") % 10 > 0, "common").alias("why"))
    df = df.unionByName(spark.createDataFrame([(None, "no key"), ("000007", "common")], "designation string, why string"))
    out = validate.counted(df, "why")
    got = {r["reason"]: (r["rejected_count"], r["examples"]) for r in out.collect()}
    assert got == {"common": (45_001, ["000001", "000002", "000003", "000004", "000005"]), "no key": (1, [])}
    assert "collect_set" not in out._jdf.queryExecution().toString()


def test_a_hot_body_is_pooled_like_any_other(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("designation"),
        (F.col("id") % 7 + 100).cast("double").alias("diameter_km"), F.lit(0.5).alias("diameter_sigma_km"),
        F.concat(F.lit("r"), F.col("id") % 3, F.lit("|s")).alias("refs"), F.col("id").alias("n"),
    )
    out = pool.pool(hot, [("diameter_km", "diameter_sigma_km")], texts=("refs",), ties=("n",))
    got = {r["designation"]: r for r in out.collect()}
    assert len(got) == 3001 and sum(r["n_fits"] for r in got.values()) == 30_000
    values = [k % 7 + 100 for k in range(30_000) if k % 10]
    assert got["hot"]["diameter_km"] == pytest.approx(statistics.fmean(values))
    assert got["hot"]["diameter_sigma_km"] == pytest.approx(statistics.pstdev(values))
    assert got["hot"]["refs"] == "r1|s|r2|r0" and got["hot"]["n"] == 1


@pytest.mark.parametrize("share", [1, 10**9])
def test_counted_join_is_a_join(spark, share, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SHARE", share)
    big = spark.createDataFrame([(k % 5, k) for k in range(100)] + [(None, 1)], "k int, v int")
    side = big.where("k < 4").groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    want = sorted((k, v, 95 + k) for k, v in rows(big.where("k < 4"), "k", "v"))
    assert sorted(map(tuple, skew.join_counted(big, side, "k", "n").collect())) == want


def test_only_shared_keys_are_combined(spark):
    df = spark.createDataFrame([("Name", 1.0, None), ("name", None, 2.0), ("3", 5.0, None), (None, 7.0, None)], "designation string, x double, y double")
    got = rows(survivor.combine_shared(df), "designation", "x", "y")
    assert got == sorted([("Name", 1.0, 2.0), ("3", 5.0, None), (None, 7.0, None)], key=str)


def test_orbits_are_adopted_whole(spark):
    a = spark.createDataFrame([("1", 2.0, 0.1), ("2", 2.0, None), ("3", 2.0, None)], "designation string, semi_major_axis_au double, eccentricity double")
    b = spark.createDataFrame([("1", 3.0, 0.3, "x"), ("2", 3.0, 0.3, "x"), ("4", None, 0.4, None)], "designation string, semi_major_axis_au double, eccentricity double, element_epoch_timescale string")
    both = ("semi_major_axis_au", "eccentricity")
    out = merge.merge([merge.SourceSpec("a", a), merge.SourceSpec("b", b)], set(), whole=(*both, "element_epoch_timescale"), required=both)
    got = rows(out, "designation", *both, "element_epoch_timescale", "orbit_provider")
    assert got == [("1", 2.0, 0.1, None, "a"), ("2", 3.0, 0.3, "x", "b"), ("3", 2.0, None, None, "a"), ("4", None, 0.4, None, "b")]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, **kw):
            self.kw = kw

        def get(self, key, default=None):
            return self.kw.get(key, default)

    class Session:
        def __init__(self, **kw):
            self.conf = Conf(**kw)

    assert staging.scratch_root(Session(**{"spark.checkpoint.dir": "x:/y/"})) == "x:/y"
    with pytest.raises(staging.NoSharedFolder):
        staging.scratch_root(Session(**{"spark.master": "spark://host:7077"}))


def test_phases_add_back(spark):
    coarse = {(r["class"], r["phase"]): r["fraction"] for r in minerals.phase_fractions(spark).collect()}
    fine = {}
    for r in minerals.detailed_fractions(spark).collect():
        fine[r["class"]] = fine.get(r["class"], 0) + r["fraction"]
    extra = {}
    for c, _, f in dims._rows(dims.REFINED_ACCESSORIES):
        extra[c] = extra.get(c, 0) + f
    for cls in {c for c, _ in coarse}:
        total = sum(v for (c, _), v in coarse.items() if c == cls)
        assert total < 1.0
        assert fine[cls] == pytest.approx(total + extra.get(cls, 0))


def test_lookup_is_literal(spark):
    df = spark.createDataFrame([("1", "A.C", None), ("2", "ABC", "2020 AB"), ("3", None, None)], "designation string, name string, provisional_designation string")
    assert rows(lookup.lookup(df, "a.c"), "designation") == [("1",)]
    assert rows(lookup.lookup(df, "  "), "designation") == []
    assert rows(lookup.lookup(df, "none"), "designation") == []


def test_readers(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"Number": "(5)", "Name": "N", "Principal_desig": "2020 AB", "Other_desigs": ["1999 XX"]}\n{"Name": "only"}\n')
    assert rows(readers.identity_links(spark, str(tmp_path / "l.json")), "alias", "to_designation") == [("1999 XX", "5"), ("2020 AB", "5"), ("N", "5")]
    src = spark.createDataFrame([(1, 2.0)], "`diameter.value` int, other double")
    df, missing = readers.wanted_columns(src, {"diameter.value": "d", "key": "k"}, ("key",))
    assert missing == ["key"] and df.count() == 0
    readers.write_csv(spark.createDataFrame([("007", ["a"])], "designation string, m array<string>"), str(tmp_path / "csv"))
    back = readers.catalog(spark, str(tmp_path / "csv"), spark.createDataFrame([], "designation string, m string").schema)
    assert rows(back, "designation") == [("007",)]
    with pytest.raises(readers.MissingColumn):
        readers.delimited(spark, str(tmp_path / "l.json"), back.schema, "designation")


def test_column_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "z int, d_sigma int, d int, a int")
    assert merge.column_order(df, ["a"], {"d": ["d_sigma"]}).columns == ["a", "z", "d", "d_sigma"]


@pytest.mark.parametrize("limit", [distinct.MAX_DISTINCT, 0])
def test_columns_are_evaluated_once_per_distinct_value(spark, limit, monkeypatch):
    monkeypatch.setattr(distinct, "MAX_DISTINCT", limit)
    calls = spark.sparkContext.accumulator(0)

    def spell(x):
        calls.add(1)
        return None if x is None else x.upper()

    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("a"), (F.col("id") % 2).alias("b"), "id")
    out = distinct.per_distinct(df, ["a", "b"], {"up": F.udf(spell, "string")(F.col("a")), "b": F.col("b") * 10})
    got = rows(out, "id", "a", "up", "b")
    assert got == sorted(((i, a, a and a.upper(), 10 * b) for a, b, i in map(tuple, df.collect())), key=str)
    assert out.columns == ["a", "b", "id", "up"] and calls.value == 8


def test_counts_in_flight_and_their_policies(spark):
    df = spark.createDataFrame([("1", 1.0), ("1.0", None), (None, 2.0)], "designation string, x double")
    out, report = survivor.combine_counted(df, "s")
    assert out.count() == 1 and [tuple(r) for r in report.collect()] == [("s", 3, 1, False)]
    keyless = df.where("designation is null")
    with pytest.raises(counts.Alarm, match="s: 1 rows went in"):
        survivor.combine_counted(keyless, "s", policy="fail")
    with pytest.warns(UserWarning, match="none came out"):
        _, report = survivor.combine_counted(keyless, "s")
    assert report.first()["alarm"] is True
    assert survivor.combine_counted(keyless, "s", policy="ignore")[1].first()["rows_out"] == 0
    with pytest.raises(ValueError):
        counts.Watch("loud")


def test_zero_overlap_stops_a_strict_merge(spark):
    a, b = (spark.createDataFrame([(k,) for k in ks], "designation string") for ks in (["1", "2"], ["3.0", "4.0"]))
    spec = [merge.SourceSpec("a", a), merge.SourceSpec("b", b)]
    assert [tuple(r) for r in merge.overlap_report(spec).collect()] == [("b", 0, 2, True)]
    with pytest.raises(counts.Alarm, match="b matches no key"):
        merge.overlap_report(spec, policy="fail")
    watch = counts.Watch("fail")
    staging.staged(merge.merge([spec[0], merge.SourceSpec("b", a.limit(1).unionByName(b))], set(), watch=watch), "wide")
    assert merge.overlap_of(watch, spec) == [("b", 1, 2, False)]
    merge.judge_overlap(watch, spec)


def test_merge_shuffles_every_source_once(spark):
    parts = [spark.range(100).select(F.col("id").cast("string").alias("designation"), F.col("id").alias(f"v{k}")) for k in range(5)]
    out = merge.merge([merge.SourceSpec(f"s{k}", p) for k, p in enumerate(parts)], set())
    plan = out._jdf.queryExecution().sparkPlan().toString()
    full = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and full.count("Exchange hashpartitioning") == 1
    assert out.count() == 100


def test_a_table_without_shared_keys_is_left_alone(spark):
    df = spark.createDataFrame([("1", 1.0), ("2", None), (None, 2.0), (None, 2.0)], "designation string, x double")
    watch = counts.Watch()
    assert survivor.combine_shared(df, watch=watch) is df
    assert watch.counts("dedup") == {"rows_in": 4, "rows_out": 4}


def test_a_documented_reason_excuses_a_low_estimate(spark):
    stats = spark.createDataFrame([("S", 5, 4.0, 0.1), ("Sq", 5, 4.0, 0.1), ("C", 2, 4.0, 0.1), ("V", 9, 1.0, 0.1), ("M", 9, 3.9, 0.1)], "comp_class string, n long, mean double, sd double")
    why = spark.createDataFrame([("Sq", "few"), ("V", "few"), ("C", "few")], "class string, reason string")
    got = rows(calibrate.class_verdict(stats, dims.classes(spark), why), "comp_class", "verdict", "reason")
    assert got == [("C", "not judged", None), ("M", "ok", None), ("S", "too low", None), ("Sq", "ok", "few"), ("V", "too high", None)]


def test_many_volumes_are_joined_by_a_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([("4", 500.0, 1.0, "x"), ("5", 1.0, None, "x")], "designation string, diameter_km double, diameter_sigma_km double, diameter_provider string")
    a = merge.override_diameters(df, dims.shape_volumes(spark))
    monkeypatch.setattr(merge, "MAX_VOLUMES", 1)
    assert rows(merge.override_diameters(df, dims.shape_volumes(spark)), *df.columns) == rows(a, *df.columns)
