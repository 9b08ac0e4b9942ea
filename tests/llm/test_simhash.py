import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orrery.llm import components, simhash

WORD = r"[^\x20\x09-\x0D]+"


def slow_fingerprint(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(find(i), []).append(d)
    least = {g: min((d for d in m if d is not None), default=None) for g, m in members.items()}
    return sorted(((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("crowded", [256, 2])
def test_components_match_brute_force(docs, crowded):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs, crowded).collect()), key=str)
    assert got == brute(rows)


def test_crowded_buckets_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4)
    fps = {int(b) ^ sum({1 << int(x) for x in rng.integers(0, 63, k)}) for b in base for k in rng.integers(0, 7, 120)}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    parts = simhash.plan(np.array(sorted(fps), dtype=np.int64).view(np.uint64), len(fps))
    want = None
    for crowded in (10**9, 1, 8):
        roots = components.connected(simhash.links(nodes, parts, crowded))
        got = sorted(map(tuple, nodes.join(roots, nodes.fp == roots.u, "left").select("fp", F.coalesce("root", "fp").alias("r")).collect()))
        want = want or got
        assert got == want
    par = {f: f for f in fps}

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 4:
                par[max(find(a), find(b))] = min(find(a), find(b))
    assert want == sorted((f, find(f)) for f in fps)


@pytest.mark.parametrize("rows", [10, 10**5, 10**8])
def test_plan_keeps_the_pigeonhole_sum(rows):
    sample = np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64)
    assert sum(t + 1 for _, t in simhash.plan(sample, rows)) == simhash.DISTANCE + 1
    bits = [b for p, _ in simhash.plan(sample, rows) for b in p]
    assert len(bits) == len(set(bits))


def test_pairs_by_equal_blocks_are_all_near_pairs(spark):
    rng = np.random.default_rng(4)
    base = [int(b) for b in rng.integers(0, 2**63, 3)]
    fps = sorted({b ^ sum({1 << int(x) for x in rng.integers(0, 63, k)}) for b in base for k in rng.integers(0, 9, 60)})
    parts = [(list(range(0, 20)), 1), (list(range(20, 42)), 1), (list(range(42, 64)), 0)]
    for part, (bits, _) in enumerate(parts):
        mask = sum(1 << b for b in bits)
        rows = [(part, f & (mask if mask < 2**63 else 0), f) for f in fps]
        t = spark.createDataFrame([(p, 0, f) for p, _, f in rows], "part int, key long, fp long")
        got = simhash._agreeing(t.withColumnRenamed("fp", "u"), t.withColumnRenamed("fp", "v"), parts).distinct()
        want = sorted((a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 4)
        assert sorted(map(tuple, got.collect())) == want


def test_hot_fingerprints_and_components(spark, prose):
    texts = [prose(1, 60)] * 400 + [prose(2, 60) + f" w{k}" for k in range(150)] + [prose(100 + k, 60) for k in range(30)] + [None] * 50
    rows = [(k if k % 11 else None, t) for k, t in enumerate(texts)]
    got = sorted((tuple(r) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()), key=str)
    assert got == brute(rows)


def test_columns_of_any_name_and_type_are_kept(spark, docs):
    extra = {"_row": F.lit("r"), "_stay": F.lit(1), "_n": F.lit(2), "component_id": F.lit(3), "tags": F.create_map(F.lit("k"), F.col("doc_id"))}
    wide = docs.withColumns(extra)
    kept = simhash.keep_one(wide)
    assert kept.columns == wide.columns and kept.count() == simhash.keep_one(docs).count()
    assert {r["_row"] for r in kept.collect()} == {"r"}


def test_keep_one_and_empty(docs, empty):
    found = simhash.near_duplicates(docs)
    groups = found.select("component_id").distinct().count()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_rows_without_or_under_one_id_are_kept_apart(spark, prose):
    rows = [(None, prose(i, 80)) for i in range(5)] + [(1, prose(10 + i, 80)) for i in range(4)]
    rows += [(5, prose(0, 80)), (6, prose(0, 80)), (2, prose(11, 80)), (None, prose(3, 80))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(5, prose(0, 80))] + [(None, prose(i, 80)) for i in range(1, 5)] + [(1, prose(10 + i, 80)) for i in range(4)]
    assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "u long, v long")
    got = dict(map(tuple, components.connected(edges).collect()))
    assert set(got.values()) == {0, 1000} and len(got) == 301
