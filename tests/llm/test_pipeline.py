import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from orrery.llm import bpe, quality_resample, toxicity
from orrery.llm.queries import TOKENIZER
from test_native import slow
from test_simhash import slow_fingerprint

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@here
def test_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0 < docs.count() <= left
        left = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = sorted(map(tuple, last.collect()))
    assert len(want) == left
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


# --- the five decisions in plain Python; rows are (doc_id, text)


def selected(rows, labels):
    q, m64 = quality_resample, (1 << 64) - 1
    good = {}
    for d, quality, _ in labels:
        if quality in (0, 1) and d is not None:
            good[d] = min(quality, good.get(d, 1))

    def grams(text):
        words, out = (text or "").encode().split(), []
        form = [2 * zlib.crc32(q.shape(w.decode()).encode()) + (k > 0 and w == words[k - 1]) for k, w in enumerate(words)]
        for base, seq in ((0, [zlib.crc32(w) for w in words]), (q.HALF, form)):
            for h in [a + 1 for a in seq] + [a * 0xC2B2AE3D27D4EB4F + b + 7 for a, b in zip(seq, seq[1:])]:
                out.append(base + (h * 0x9E3779B97F4A7C15 & m64) // (2**64 // q.HALF))
        return out

    each = [grams(t) for _, t in rows]
    raw, target = Counter(b for g in each for b in g), Counter(b for (d, _), g in zip(rows, each) if good.get(d) == 1 for b in g)
    ratio = {}
    for lo in (0, q.HALF):
        part = range(lo, lo + q.HALF)
        n, m = (sum(c[b] for b in part) + q.HALF for c in (raw, target))
        for b in part:
            p = (raw[b] + 1) / n
            ratio[b] = math.log((target[b] + p * q.HALF) / m / p)
    weight = [sum(ratio[b] for b in g) for g in each]

    def noise(d):
        h = xxhash.xxh64_intdigest(struct.pack("<i", q.SEED), 42)
        h = h if d is None else xxhash.xxh64_intdigest(struct.pack("<q", d), h)
        return -math.log(-math.log((h // 2**11 + 0.5) / 2**53))

    key = [w + noise(d) for w, (d, _) in zip(weight, rows)]
    pairs = sorted((w, good[d]) for w, (d, _) in zip(weight, rows) if d in good)

    def parted(k):
        """Share of bad labels below the k-th pair less the share of good ones."""
        below = [g for _, g in pairs[:k]]
        ones = sum(g for _, g in pairs)
        return below.count(0) / (len(pairs) - ones) - below.count(1) / ones

    k = max((k for k in range(len(pairs)) if k == 0 or pairs[k][0] - pairs[k - 1][0] > 1e-9), key=parted)
    assert k > 0
    cut = pairs[k - 1][0] + 0.1 * (pairs[k][0] - pairs[k - 1][0])
    edge = sorted(key, reverse=True)[sum(w >= cut for w in weight) - 1]
    return [r for r, x in zip(rows, key) if x >= edge]


def clean(rows, labels):
    """The features and bags are made here; the fitter of the weights is the library's."""
    toxic = {}
    for d, _, y in labels:
        if d is not None and y in (0, 1) and zlib.crc32(str(d).encode()) % 5:
            toxic[d] = max(y, toxic.get(d, 0))

    def said(text):
        words = [set(re.findall(r"\w+", s)) for s in re.split(r"[.!?\n]+", (text or "").lower())]
        return [{f for w in ws for f in toxicity.features(w)} for ws in words if ws]

    bags = [(toxic[d], said(t)) for d, t in rows if d in toxic and t is not None]
    n = Counter(y for y, _ in bags)
    held = Counter((y, f) for y, ss in bags for f in set().union(*ss))
    chosen = [f for y, f in held if y and held[1, f] >= max(3, 0.02 * n[1]) and held[1, f] * n[0] >= 15 * n[1] * (held[0, f] + 1)]
    place = {f: k for k, f in enumerate(sorted(chosen, key=lambda f: (-held[1, f], f))[:5000])}
    full = [[sorted(place[f] for f in s if f in place) for s in ss] for _, ss in bags]
    model = toxicity.train(
        [{"toxic": y, "sentences": [s for s in ss if s], "times": [1 for s in ss if s]} for (y, _), ss in zip(bags, full)], list(place)
    )

    def score(text):
        none = 1.0
        for words in (re.findall(r"\w+", s) for s in re.split(r"[.!?\n]+", (text or "").lower())):
            own = [model.weight[f] for w in set(words) for f in toxicity.features(w) if f in place]
            none *= 1 - 1 / (1 + math.exp(-model.bias - sum(own))) if own else 1
        return 1 - none

    return [r for r in rows if score(r[1]) < 0.5]


def one_of_each(rows):
    fps, groups = [slow_fingerprint(t) for _, t in rows], []
    for k, fp in enumerate(fps):
        near = [g for g in groups if any((fp ^ fps[j]).bit_count() <= 4 for j in g)]
        groups = [g for g in groups if g not in near] + [[k, *[j for g in near for j in g]]]
    return [min((rows[j] for j in g), key=lambda r: (r[0] is None, r[0] or 0)) for g in groups]


def unseen(rows, items):
    return [r for r in rows if not slow([r], items)[0][-1]]


def encoded(rows):
    tok = bpe.load(public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.ranks, special_tokens={})
    out = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        sums = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), library.decode_bytes(ids))]
        out.append((d, len(ids), *sums))
    return out


def test_run_equals_plain_python(spark, prose, tmp_path):
    passage = prose(900, 30)
    # Long texts of the style of the rest: neither length nor any one stage may drop them.
    long = lambda *span: " ".join(prose(i, 60 + i % 90) for i in range(*span))
    rows = [(i, prose(i, 60 + i % 90)) for i in range(120)]
    rows += [(200 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split())) for i in range(30)]
    rows += [(300 + i, f"{prose(400 + i, 50)}. You vile grumble. {prose(500 + i, 20)}") for i in range(30)]
    rows += [(400 + i, prose(i, 60 + i % 90)) for i in range(10)] + [(420, long(61, 120, 2)), (421, long(61, 120, 2) + " tail")]
    rows += [(500 + i, f"{prose(700 + i, 10 * i)} {passage}") for i in range(8)] + [(510, f"{long(1, 60, 2)} {passage}")]
    rows += [(600, long(1, 120, 2))]
    rows += [(None, prose(801, 70)), (None, prose(802, 70)), (7, prose(803, 70)), (7, prose(7, 67)), (701, None), (702, ""), (703, " \n")]
    labels = [(d, int(not 200 <= d < 300) if d % 2 else None, int(300 <= d < 400)) for d, _ in rows if d is not None and d < 400]
    labels += [(None, 1, 1), (9999, 0, 1), (1, 1, 0)]
    items = [(1, passage), (2, prose(901, 13)), (3, None), (4, "")]
    for name, data, schema in (
        ("documents", [(*r, "clash", "clash") for r in rows], "doc_id long, text string, score string, _key string"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).repartition(3, F.rand(1)).write.parquet(str(tmp_path / f"{name}.parquet"))

    kept = [selected(rows, labels)]
    kept.append(clean(kept[-1], labels))
    kept.append(one_of_each(kept[-1]))
    kept.append(unseen(kept[-1], items))
    assert len(rows) > len(kept[0]) > len(kept[1]) > len(kept[2]) > len(kept[3])
    left = {d for d, _ in kept[-1]}
    assert not left & {*range(200, 230), *range(300, 330), *range(400, 410), *range(500, 504)} and {510, 600} <= left and len(left & {420, 421}) == 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(encoded(kept[-1]), key=str)


def test_run_on_empty_tables(spark, tmp_path):
    for name, schema in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(got.columns) and got.count() == 0
