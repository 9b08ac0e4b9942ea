import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from orrery.llm import common, decontaminate, quality_rules, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# --- sharding


@pytest.mark.parametrize("size", [4, 100])
def test_shards_differ_by_one_and_slots_have_no_gaps(docs, size):
    got = [r.asDict() for r in sharding.place(docs, bucket_records=size).collect()]
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for k, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(n))
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_order_is_shuffled_and_hot_ids_scatter(spark, empty):
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.place(hot, bucket_records=50).collect()
    per = Counter(r["shard"] for r in got if r["doc_id"] == 7)
    assert max(per.values()) < 1.4 * min(per.values())
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] != 7]
    assert sum(a < b for a, b in zip(order, order[1:])) < 0.6 * len(order)
    assert sharding.place(empty).count() == 0


def test_whole_records_are_written(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(r["text"] for r in back.collect()) == Counter(r["text"] for r in docs.collect())
    assert set(docs.columns) < set(back.columns)
    clash = docs.withColumns({"shard": F.lit("own"), "_row": F.lit(1), "_slot": F.lit(2)})
    assert sharding.write_shards(clash, str(tmp_path / "clash")) == "shard_"
    back = spark.read.parquet(str(tmp_path / "clash"))
    assert {r["shard"] for r in back.collect()} == {"own"} and set(clash.columns) < set(back.columns)


def test_offsets_count_what_is_before(spark, monkeypatch):
    monkeypatch.setattr(sharding, "OFFSET_GROUP", 4)
    sizes = {b: b * b % 7 for b in range(30) if b % 5}
    table = spark.createDataFrame(list(sizes.items()), "bucket int, n int").repartition(3)
    got = {r["bucket"]: r["offset"] for r in sharding._offsets(table).collect()}
    assert got == {b: sum(n for a, n in sizes.items() if a < b) for b in sizes}


@pytest.mark.parametrize("size", [4, 512])
def test_files_hold_the_placed_order(docs, tmp_path, size):
    sharding.write_shards(docs, str(tmp_path / "shards"), bucket_records=size)
    placed = sharding.place(docs, bucket_records=size).orderBy("shard", "slot").collect()
    for k in range(8):
        files = sorted((tmp_path / "shards" / f"shard={k}").glob("*.parquet"))
        rows = [r for f in files for r in pq.ParquetFile(f).read().to_pylist()]
        want = [(r["doc_id"], r["text_crc32"]) for r in placed if r["shard"] == k]
        assert [(r["doc_id"], zlib.crc32((r["text"] or "").encode())) for r in rows] == want


# --- decontamination


def slow(rows, items):
    wins = {}
    for i, t in items:
        w = terms(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, own = terms(t), set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if o := wins.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    own |= o
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark, docs, prose):
    passage = prose(900, 40).replace("\n", " ")
    items = [(1, passage), (2, passage + " more words"), (3, "a b a b a b a b a b a b a b a b"), (4, "single"), (5, "two words"), (6, None), (7, "..."), (8, prose(901, 13)), (8, "single"), (9, "x"), (None, "without an id"), (None, "nor one")]
    extra = [
        (9001, "before it " + passage.upper() + " after", None, None, None, None), (9002, "a b " * 40, None, None, None, None),
        (9003, prose(902, 3000) + " " + passage, None, None, None, None), (9004, "Single two-words two, words", None, None, None, None), (9005, "Nor one, without an id", None, None, None, None),
        (9001, "another text under one id " + passage, None, None, None, None),
    ]
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted((tuple(r)[:6] for r in decontaminate.contamination(rows, bench).collect()), key=str)
    assert got == slow([tuple(r) for r in rows.select("doc_id", "text").collect()], items)
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(rows, bench).collect()}
    assert 9001 not in kept and 9003 in kept and None in kept


def test_rows_are_dropped_each(spark, prose):
    passage = prose(900, 40)
    rows = [(d, t) for d in (None, 3) for t in (passage, prose(1, 60), prose(2, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, bench).collect()
    assert sorted(map(tuple, kept), key=str) == sorted((x for x in rows if x[1] != passage), key=str)


def test_contamination_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(docs, none).collect()
    assert len(got) == docs.count() and not any(r["contaminated"] or r["n_hit"] for r in got)
    assert decontaminate.contamination(empty, none).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha one two beta gamma"), (2, "alpha x x x x x x x x x beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta")], "doc_id long, text string")
    terms_ = spark.createDataFrame([(k, w) for k, w in enumerate(["alpha", "beta", "gamma", "delta"])], "term long, word string")
    index = decontaminate.build_index(docs, terms_)
    freq = decontaminate.frequencies(index, terms_)
    queries = spark.createDataFrame([(1, ["alpha", "beta", "gamma", "beta"], 5), (2, ["alpha", "delta"], 90)], "query_id int, terms array<string>, reach int")
    near = decontaminate.proximity(index, queries, freq)
    found = near.join(index.select("rid", "doc_id").distinct(), "rid").select("doc_id", "query_id", "start", "stop").collect()
    assert sorted(map(tuple, found)) == [(1, 1, 0, 4), (3, 1, 0, 2)]


def slow_near(texts, items):
    every = Counter(w for t in texts for w in terms(t))
    out = []
    for t in texts:
        at = {}
        for k, w in enumerate(terms(t)):
            at.setdefault(w, []).append(k)
        near = set()
        for i, item in items:
            rare = sorted(set(terms(item)), key=lambda w: (every[w], w))[:4]
            n = len(terms(item))
            if rare and any(all(any(abs(p - k) < n for p in at.get(w, [])) for w in rare) for k in at.get(rare[0], [])):
                near.add(i)
        out.append(len(near))
    return out


@pytest.mark.parametrize("limit", [500_000, 3])
def test_near_matches_equal_brute_force(spark, docs, prose, limit, monkeypatch):
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", limit)
    items = [(k, prose(k, 6 + k % 9)) for k in range(0, 40, 7)] + [(90, prose(900, 40)), (90, "x"), (91, None), (92, "k"), (93, "nowhere else zzz")]
    turned = " ".join(reversed(prose(900, 40).split()))
    extra = [(9001, f"before {turned} after", None, None, None, None), (9002, prose(3, 900) + prose(900, 40), None, None, None, None)]
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema)).coalesce(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_near"], r["n_words"]) for r in decontaminate.contamination(rows, bench).collect())
    data = [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]
    near = slow_near([t for _, t in data], items)
    assert got == sorted((str(d), n, len(terms(t))) for (d, t), n in zip(data, near)) and max(near) >= 1


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("most", [65_536, 0])
def test_rows_are_filtered_by_number(spark, most, keep, monkeypatch):
    monkeypatch.setattr(common, "MAX_BITMAPS", most)
    names = "id long, _row string, _BUCKET int, _bits int, _chosen int"
    docs = spark.range(70_000).select("id", F.lit("x").alias("_row"), F.lit(1).alias("_BUCKET"), F.lit(2).alias("_bits"), F.lit(3).alias("_chosen")).repartition(3)
    rows, number = common.numbered(docs.to(spark.createDataFrame([], names).schema), "numbers")
    assert number == "_row_"
    wanted = F.xxhash64("id") % 3 == 0
    out = common.filter_rows(rows, number, rows.where(wanted).select(number), keep)
    assert out.columns == docs.columns
    want = {r["id"] for r in docs.where(wanted if keep else ~wanted).collect()}
    assert {r["id"] for r in out.collect()} == want and out.count() == len(want)


# --- quality rules


def counts(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_statistics_match_brute_force(spark, docs, prose):
    extra = [(1, prose(5, 30) * 2), (2, "a b c d e f g h " * 3 + "i"), (3, "x\n\nx\n y\nx\n"), (4, "w " * 9), (5, "one\ttwo\x0bthree\x1cfour\u00a0five")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = sorted((tuple(r)[:6] for r in quality_rules.statistics(rows).collect()), key=str)
    assert got == sorted(((r["doc_id"], *counts(r["text"])) for r in rows.collect()), key=str)


def test_rules_are_learned_and_ordered(spark, prose):
    good = [(i, prose(i, 80)) for i in range(60)]
    junk = [(100 + i, " ".join(w + "##" for w in prose(i, 80).split())) for i in range(40)]
    shout = [(200 + i, prose(700 + i, 80).upper()) for i in range(40)]
    docs = spark.createDataFrame(good + junk + shout, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 100)) for d, _ in good + junk + shout], "doc_id long, quality int").withColumn("rule", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    ok = [got[d]["kept"] == (d < 100) or got[d]["base_failed"] for d, _ in good + junk + shout]
    assert sum(ok) >= 0.95 * len(ok)
    assert all(r["rule"] for r in got.values() if not r["kept"] and not r["base_failed"])


def slow_list(rows, bad):
    """Sequential covering over ratios of labelled rows, condition by condition."""
    names = list(quality_rules.FEATURES)
    order = {f: sorted(r[f] for _, r in rows) for f in names}
    cuts = {f: sorted({v[max(1, math.ceil(q * len(v))) - 1] for q in quality_rules.CUTS}) for f, v in order.items()}
    hold = {d: ((xxhash.xxh64_intdigest(struct.pack("<q", d), 42) + 2**63) % 2**64 - 2**63) % 3 == 0 for d, _ in rows}

    def fires(rule, r):
        return all((r[f] > c) == above for f, above, c in rule)

    def share(part, rule):
        hit = [bad[d] for d, r in part if fires(rule, r)]
        return sum(hit), len(hit)

    rules, left = [], rows
    while len(rules) < quality_rules.MAX_RULES:
        grow, rule = [x for x in left if not hold[x[0]]], []
        while len(rule) < quality_rules.MAX_CONDITIONS:
            p0, all0 = share(grow, rule)
            best, most = None, 1e-9
            for f, c, above in ((f, c, above) for f in names for c in cuts[f] for above in (True, False)):
                p, n = share(grow, [*rule, (f, above, c)])
                if p and p0 < all0:
                    gain = p * (math.log2(p / n) - math.log2(p0 / all0))
                    if gain > most:
                        best, most = (f, above, c), gain
            if best is None:
                break
            rule.append(best)
        held = [x for x in left if hold[x[0]]]
        while len(rule) > 1:
            (p, n), (q, m) = share(held, rule), share(held, rule[:-1])
            if q / (m or 1) < p / (n or 1):
                break
            rule.pop()
        p, n = share(left, rule)
        if not rule or n < quality_rules.MIN_COVER or p < quality_rules.MIN_PRECISION * n:
            break
        rules.append(rule)
        left = [x for x in left if not fires(rule, x[1])]
    return rules


def test_learned_list_equals_plain_covering(spark):
    rng, rows, labels = random.Random(3), [], []
    for d in range(600):
        n = rng.randint(15, 60)
        bad = d % 3 == 0
        r = [d, n, 5 * n + rng.randint(0, n), rng.randint(0, 3), rng.randint(0, 2), rng.randint(0, n // 5), rng.randint(0, n), rng.randint(0, 2), rng.randint(0, 2)]
        if bad:
            k = rng.choice([3, 6, 7, 8])
            r[k] += rng.randint(n // 3, 2 * n)
        rows.append(tuple(r))
        labels.append((d, int(not bad) ^ (rng.random() < 0.04)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bang", "n_echo"]
    stats = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
    got = quality_rules.learn(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    ratio = {
        "symbols_per_word": lambda r: r["n_symbols"] / r["n_words"], "repeat_share": lambda r: r["n_repeat_words"] / r["n_words"],
        "upper_share": lambda r: r["n_upper"] / r["word_chars"], "bang_per_word": lambda r: r["n_bang"] / r["n_words"],
        "dup_lines": lambda r: float(r["n_dup_lines"]), "chars_per_word": lambda r: r["word_chars"] / r["n_words"],
        "echo_share": lambda r: r["n_echo"] / r["n_words"],
    }
    named = [dict(zip(names, r)) for r in rows]
    named = [r for r in named if r["n_words"] >= 20 and 100 * r["n_repeat_words"] <= 30 * r["n_words"]]
    want = slow_list([(r["doc_id"], {f: ratio[f](r) for f in ratio}) for r in named], {d: 1 - y for d, y in labels})
    assert len(want) >= 2 and [[(c.feature, c.above, c.cut) for c in rule] for rule in got] == want
    first = {r["doc_id"]: next((k for k, rule in enumerate(want, 1) if all((ratio[f](r) > c) == above for f, above, c in rule)), 0) for r in named}
    fired = stats.withColumn("fired", quality_rules.verdict(got)).select("doc_id", "fired").collect()
    assert {r["doc_id"]: r["fired"] for r in fired if r["doc_id"] in first} == first


def test_list_does_not_depend_on_partitions_or_order_of_labels(spark):
    rng, rows, labels = random.Random(5), [], []
    for d in range(400):
        n = rng.randint(30, 90)
        bad = d % 4 == 0
        rows.append((d if d else None, n, 5 * n, 0, 0, 0, 0, rng.randint(0, 3) + 9 * bad, rng.randint(0, 2)))
        labels += [(d, int(not bad))] * (1 + d % 3)
    rows += [(7, 40, 200, 0, 0, 0, 0, 1, 1)] * 300
    labels += [(7, 0), (7, 1), (None, 0), (None, 1), (12345, 0), (3, None)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bang", "n_echo"]
    stats = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    lists = [quality_rules.learn(stats.repartition(k, "n_bang"), y.repartition(k)) for k in (1, 3, 11)]
    assert lists[0] and lists[0] == lists[1] == lists[2]
    # Every labelled row counts once per label: the thresholds are values at these ranks.
    of = {d: [q for i, q in labels if i == d and q is not None] for d in range(400)}
    seen = sorted(r[7] / r[1] for r in rows if r[0] is not None for _ in of[r[0]])
    cuts = {seen[max(1, math.ceil(q * len(seen))) - 1] for q in quality_rules.CUTS}
    assert {c.cut for rule in lists[0] for c in rule if c.feature == "bang_per_word"} <= cuts


def test_rules_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.judge(docs, none).collect()
    assert len(got) == docs.count() and all(r["kept"] != r["base_failed"] for r in got)
    assert quality_rules.judge(empty, none).count() == 0


def test_native_plans_run_no_python(spark, docs):
    items = spark.createDataFrame([(1, "some words of a benchmark item that is long enough to be one window")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    for df in (sharding.place(docs), decontaminate.contamination(docs, items), quality_rules.statistics(docs), quality_rules.judge(docs, labels)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
