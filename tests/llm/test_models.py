import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.llm import bpe, language_id, lm_scoring, quality_resample, toxicity, url_filter
from orrery.llm.queries import TOKENIZER

PATH, PATTERN = public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    tok = bpe.load(PATH, PATTERN)
    return tok, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tok.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("aeinrst  \n'.é日"))), max_size=80))
def test_encoding_equals_the_library(library, text):
    tok, other = library
    ids = tok.encode(text)
    assert ids == other.encode_ordinary(text)
    assert tok.decode(ids) == text.encode()


def test_digests_and_round_trip(docs, empty, library):
    got = {}
    for r in bpe.digest(docs, PATH, PATTERN).collect():
        got.setdefault(r["doc_id"], set()).add(tuple(r)[1:])
    for r in docs.select("doc_id", "text").collect():
        ids = library[1].encode_ordinary(r["text"] or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        assert want in got[r["doc_id"]]
    back = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in docs.collect())
    assert bpe.digest(empty, PATH, PATTERN).count() == 0


@pytest.mark.parametrize("piece", ["a" * 300_000, "ab" * 100_000, "é" * 100_000])
def test_a_very_long_piece_takes_linear_time(library, piece):
    ids = library[0].encode(piece)
    assert library[0].decode(ids) == piece.encode()
    assert library[0].encode(piece[:20_000]) == library[1].encode_ordinary(piece[:20_000])


# --- language ID


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in language_id._initial(3, rng).items()}
    x, y = rng.integers(97, 123, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    mask = np.ones((7, 5))
    mask[5:, 2] = 0
    _, g = language_id._gradients(p, x, mask, y)
    for name in ("ugf", "ucb", "of", "bias"):
        at = tuple(0 for _ in p[name].shape)
        moved = []
        for d in (1e-2, -1e-2):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += d
            moved.append(language_id._gradients(q, x, mask, y)[0])
        assert g[name][at] == pytest.approx((moved[0] - moved[1]) / 2e-2, rel=0.05, abs=1e-4)


def test_languages_are_told_apart(spark, prose):
    other = lambda s: s.replace("th", "ß").replace("o", "ü").replace("e", "ä")
    rows = [(i, prose(i, 60) if i % 2 else other(prose(i, 60)), "aa" if i % 2 else "bb") for i in range(300)]
    rows += [(900, None, "aa"), (901, "12 34 !", "aa"), (902, "", None), (None, "tharenstion", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", F.lit("clash"))
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows if i is not None)
    held = [i for i in range(300) if got[i]["held_out"]]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.97 * len(held)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_every_position_is_labelled(prose):
    model = language_id.train([prose(1, 30), prose(2, 30).upper()], ["a", "b"])
    text = prose(3, 200)
    each = language_id.position_probabilities(model, text)
    assert each.shape == (len(text.encode()), 2)
    assert np.allclose(each.mean(axis=0), language_id.pooled(model, [text.encode()])[0], atol=1e-4)


def slow_probabilities(model, text):
    """The network step by step over the whole text, as its definition says."""
    p, raw = {k: v.astype(float) for k, v in model.p.items()}, text.encode()
    states = {}
    for d in "fb":
        h, each = np.zeros(language_id.HIDDEN), {}
        for t in range(len(raw)) if d == "f" else reversed(range(len(raw))):
            g = 1 / (1 + np.exp(-(p[f"xg{d}"][raw[t]] + h @ p[f"ug{d}"])))
            c = np.tanh(p[f"xc{d}"][raw[t]] + g * (h @ p[f"uc{d}"]))
            h = each[t] = (1 - g) * h + g * c
        states[d] = each
    z = np.array([np.exp(states["f"][t] @ p["of"] + states["b"][t] @ p["ob"] + p["bias"]) for t in range(len(raw))])
    return z / z.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("words", [1, 20, 33, 120])
def test_forward_pass_equals_its_definition(prose, words):
    model = language_id.train([prose(1, 30), prose(2, 30).upper(), prose(3, 30) + "é"], ["a", "b", "c"])
    text = prose(9, words) + "äß日"
    want = slow_probabilities(model, text)
    assert np.allclose(language_id.position_probabilities(model, text), want, atol=1e-4)
    assert np.allclose(language_id.pooled(model, [b"", text.encode()])[1], want.mean(axis=0), atol=1e-4)


def slow_gates(model):
    """The same network with gates so nearly shut that a state lasts for thousands of bytes."""
    p = {k: v - np.float32(6) if k.startswith("xg") else v for k, v in model.p.items()}
    return language_id.ByteGru(model.languages, p)


@pytest.mark.parametrize("memory", [lambda m: m, slow_gates])
def test_windows_and_blocks_do_not_change_what_is_found(prose, memory):
    model = memory(language_id.train([prose(1, 30), prose(2, 30).upper(), prose(3, 30) + "é"], ["a", "b", "c"]))
    texts = ["", "x", prose(4, 20), prose(5, 400) + "日", prose(6, 300).upper()]
    want = [slow_probabilities(model, t) for t in texts[1:]]
    for window, block in ((128, 4096), (7, 5), (64, 3), (50_000, 2)):
        got = [language_id.position_probabilities(model, t, window, block) for t in texts[1:]]
        assert all(np.allclose(g, w, atol=5e-4) for g, w in zip(got, want))
        means = language_id.pooled(model, [t.encode() for t in texts], window, block)
        assert np.allclose(means[1:], [w.mean(axis=0) for w in want], atol=5e-4) and not means[0].any()


def test_very_long_and_odd_texts_have_a_language(spark, docs, prose):
    long = [(8000, prose(1, 20_000), "aa"), (8001, "é" * 60_000, "bb"), (8002, prose(2, 50), "aa"), (8002, prose(2, 50), "aa")]
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(long, "doc_id long, text string, lang string"))
    got = language_id.identify(rows).collect()
    assert len(got) == rows.count() and all(0 <= r["score"] <= 1 for r in got)
    letters = {r["doc_id"]: bool(r["text"]) and any(map(str.isalpha, r["text"])) for r in rows.collect() if r["doc_id"] is not None}
    assert all((r["lang_pred"] == "und") == (not letters[r["doc_id"]]) for r in got if r["doc_id"] is not None and r["doc_id"] != 7)
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 8002}) == 1


def test_language_without_labels(empty, docs):
    assert language_id.identify(empty).count() == 0
    got = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in got} == {"und"} and len(got) == docs.count()


# --- language-model scoring


def test_counts_and_losses_match_brute_force(spark):
    texts = ["abcabcabd", "xyzxyz", "", None, "é" * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = spark.createDataFrame([(0,)], "doc_id long")
    model = lm_scoring.tables(lm_scoring.count_ngrams(docs, target))
    raws = [(t or "").encode() for t in texts]
    for m, own in ((0, raws[:1]), (1, raws)):
        uni, bi = np.zeros(256), np.zeros(1 << 16)
        for raw in own:
            padded = bytes(3) + raw
            for i in range(3, len(padded)):
                uni[padded[i]] += 1
                bi[padded[i - 1] << 8 | padded[i]] += 1
        assert (model[m][:256] == uni).all() and (model[m][256 : 256 + (1 << 16)] == bi).all()
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, model).collect()}
    assert got[0]["xent_diff"] < 0 < got[1]["xent_diff"]
    assert got[2]["n_tokens"] == 0 and got[2]["xent_diff"] is None and got[3]["xent_diff"] is None
    n = {t: lm_scoring.losses(model, [t])[0, 0] for t in (b"abc", b"abcabc")}
    assert n[b"abc"] < n[b"abcabc"] < 2 * n[b"abc"]


def test_blocks_of_long_texts_join(monkeypatch):
    rng = np.random.default_rng(3)
    raws = [bytes(rng.integers(97, 105, n).astype(np.uint8)) for n in (5, 0, 300, 41)]
    model = rng.integers(0, 5, (2, lm_scoring.OFFSETS[-1])).astype(np.float32)
    want = lm_scoring.losses(model, raws)
    monkeypatch.setattr(lm_scoring, "BLOCK", 16)
    assert np.allclose(lm_scoring.losses(model, raws), want)


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_scores_match_exact_counts(spark, docs, chunk, monkeypatch):
    # Random bytes hold far more n-grams of order 4 than any small table has slots.
    rng = np.random.default_rng(5)
    noise = [(7000 + i, "".join(map(chr, rng.integers(1, 0x2000, 60_000)))) for i in range(2)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(noise, "doc_id long, text string")).repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 60, 4)], "doc_id long")
    count = [{}, {}]
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in rows.collect()]
    for d, raw in texts:
        padded = bytes(3) + raw
        for i in range(3, len(padded)):
            for n in range(1, 5):
                for m in range(2) if d in range(0, 60, 4) else (1,):
                    g = padded[i - n + 1 : i + 1]
                    count[m][g] = count[m].get(g, 0) + 1

    def bits(m, raw):
        padded, total, out = bytes(4) + raw, sum(v for k, v in count[m].items() if len(k) == 1), 0.0
        for i in range(4, len(padded)):
            p = (count[m].get(padded[i : i + 1], 0) + 8 / 256) / (total + 8)
            for n in range(2, 5):
                p = (count[m].get(padded[i - n + 1 : i + 1], 0) + 8 * p) / (count[m].get(padded[i - n + 1 : i], 0) + 8)
            out -= math.log2(p)
        return out / len(raw)

    want = sorted(((d, len(t), *((bits(0, t), bits(1, t)) if t else (None, None))) for d, t in texts), key=str)
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    got = sorted((tuple(r)[:4] for r in lm_scoring.cross_entropy_difference(rows, target).collect()), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1], round(r[2] or 0, 6), round(r[3] or 0, 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:2] == w[:2] and g[2:] == (pytest.approx(w[2:], abs=1e-9) if w[1] else (None, None))
    assert len(lm_scoring.tables(lm_scoring.count_ngrams(rows, target)).keys) == sum(len(k) > 2 for k in {*count[1], b"\0" * 3})


def test_scoring_empty(empty, spark):
    assert lm_scoring.cross_entropy_difference(empty, spark.createDataFrame([], "doc_id long")).count() == 0


# --- URL filter


URLS = {
    "https://WWW.Example.com/en/1?x": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "http://m.example.com/en/2#f": ("m.example.com", "/en/2", "example.com/en/", "block"),
    "http://example.com": ("example.com", "", None, None),
    "http://a.com/x": ("a.com", "/x", "com/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "https://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
    "https://a.net?u=/fr/": ("a.net", "", None, None),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "://": ("", "", None, None),
    "x://h://p": ("h:", "//p", None, None),
}


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] * 2, "page_id long, url string, verdict string")
    got = url_filter.judge(pages).collect()
    assert len(got) == 2 * len(URLS)
    want = list(URLS.values())
    for r in got:
        host, path, rule, verdict = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_trees_learn_lexical_features(spark):
    bad = [(f"http://cheap{i}-pills{i}.example.net/en/{i}?a=1&b=2&c=3", 1) for i in range(150)]
    good = [(f"https://news.site.org/story/{i}", 0) for i in range(150)]
    labelled = spark.createDataFrame(bad[:100] + good[:100], "url string, label int")
    test = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(bad[100:] + good[100:])], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.classify(test, labelled).collect()}
    assert all(got[i] == ("block" if i < 50 else "allow") for i in range(100))


def test_urls_without_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_filter.judge(one).first()["verdict"] == "allow"


# --- importance resampling


def test_junk_is_left_out(spark, prose):
    good = [(i, prose(i, 60)) for i in range(80)]
    junk = [(100 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split())) for i in range(20)]
    docs = spark.createDataFrame(good + junk + [(None, None), (500, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 100)) for d, _ in good + junk if d % 2], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_resample.resample(docs, labels).collect()}
    assert all(got[d]["kept"] for d, _ in good) and not any(got[d]["kept"] for d, _ in junk)
    assert got[None]["log_weight"] == 0 and got[500]["n_grams"] == 0
    fixed = quality_resample.resample(docs, labels, k=10).where("kept").count()
    assert fixed == 10
    kept = quality_resample.keep_selected(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["kept"]}


SHAPES = {"Hello,": "Aa,", "привет": "a", "你好": "a", "ελλάδα": "a", "Привет!": "Aa!", "ABC-12": "A-0", "##a$$": "#a$", "ÀÉ": "A", "Éaux": "Aa", "--": "-", "a" * 50: "a", "x9x9x9x9x9": "a0a0a0a0a0"}


def test_shapes_know_every_script():
    assert {w: quality_resample.shape(w) for w in SHAPES} == SHAPES


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("abAB1.ǅªʰ日é"))), min_size=1, max_size=12))
def test_the_short_way_to_a_shape_is_the_same(word):
    want = word
    for pattern, symbol in quality_resample._RUNS:
        want = pattern.sub(symbol, want)
    assert quality_resample.shape(word) == want


def test_weights_and_keys_equal_brute_force(spark, docs, prose):
    """The hashed generative models, the log ratio and the Gumbel keys in plain Python."""
    q, m64 = quality_resample, (1 << 64) - 1
    mix, mul = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    long = spark.createDataFrame([(9000, prose(1, 20_000), None, None, None, None)], docs.schema)
    rows = docs.unionByName(long)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(5, 0), (None, 1)], "doc_id long, quality int")
    good = {i: min(int(i % 3 > 0), 0 if i == 5 else 1) for i in range(60)}

    def grams(text):
        words, out = (text or "").encode().split(), []
        seqs = [[], []]
        for k, w in enumerate(words):
            seqs[0].append(zlib.crc32(w))
            form = zlib.crc32(q.shape(w.decode(errors="replace")).encode())
            seqs[1].append(2 * form + int(k > 0 and zlib.crc32(w) == zlib.crc32(words[k - 1])))
        for base, seq in zip((0, q.HALF), seqs):
            out += [base + ((t + 1) * mix & m64) // (2**64 // q.HALF) for t in seq]
            out += [base + ((a * mul + b + 7) * mix & m64) // (2**64 // q.HALF) for a, b in zip(seq, seq[1:])]
        return out

    data = [(r["doc_id"], grams(r["text"])) for r in rows.select("doc_id", "text").collect()]
    raw, target = [0] * q.BUCKETS, [0] * q.BUCKETS
    for d, g in data:
        for b in g:
            raw[b] += 1
            target[b] += good.get(d) == 1
    ratio = []
    for lo in (0, q.HALF):
        r, t = raw[lo : lo + q.HALF], target[lo : lo + q.HALF]
        n, m = sum(r) + q.HALF, sum(t) + q.HALF
        for a, b in zip(r, t):
            p = (a + 1) / n
            ratio.append(math.log((b + p * q.HALF) / m / p))
    got = q.resample(rows, labels)
    assert sorted((str(r["doc_id"]), r["n_grams"]) for r in got.collect()) == sorted((str(d), len(g)) for d, g in data)
    u = spark.createDataFrame([(d,) for d, _ in data], "doc_id long").select("doc_id", F.xxhash64(F.lit(q.SEED), "doc_id").alias("h"))
    noise = {r["doc_id"]: -math.log(-math.log(((r["h"] & m64) // 2**11 + 0.5) / 2**53)) for r in u.collect()}
    want = sorted((str(d), round(sum(ratio[b] for b in g), 6), round(sum(ratio[b] for b in g) + noise[d], 6)) for d, g in data)
    have = sorted((str(r["doc_id"]), round(r["log_weight"], 6), round(r["gumbel_key"], 6)) for r in got.collect())
    for a, b in zip(have, want):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-4)
    # The k largest keys stay, with ties.
    kept = sorted((r["gumbel_key"] for r in got.where("kept").collect()), reverse=True)
    every = sorted((r["gumbel_key"] for r in got.collect()), reverse=True)
    assert kept == every[: len(kept)] and (len(kept) == len(every) or every[len(kept)] < kept[-1])


def test_filters_keep_columns_of_any_name(spark, docs, prose):
    extra = {"_key": F.lit(1), "_weight": F.lit("w"), "_n_grams": F.lit(2), "_stay": F.lit(3), "_toxic_score": F.lit("t"), "tags": F.create_map(F.lit("k"), F.col("doc_id"))}
    wide = docs.withColumns(extra)
    quality = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    toxic = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int")
    for plain, full in (
        (quality_resample.keep_selected(docs, quality), quality_resample.keep_selected(wide, quality)),
        (toxicity.drop_toxic(docs, toxic), toxicity.drop_toxic(wide, toxic)),
    ):
        assert full.columns == wide.columns and full.count() == plain.count()
        assert all(r["_weight"] == "w" and r["_toxic_score"] == "t" and r["_key"] == 1 for r in full.collect())


@pytest.mark.parametrize("values", [[3.0], [1.0] * 50, list(range(5000)), [2.0] * 40 + [1.0] * 40 + [-1e9, 1e9]])
def test_kth_largest(spark, values):
    keys = spark.createDataFrame([(float(v),) for v in values], "key double")
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        if k <= len(values):
            assert quality_resample.kth_largest(keys, k) == sorted(values, reverse=True)[k - 1]


def test_resampling_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_resample.resample(docs, none).where("kept").count() == docs.count()
    assert quality_resample.resample(empty, none).count() == 0


# --- toxicity


def test_sentences_are_blamed(spark, prose):
    bad = lambda i: f"{prose(i, 50)}. You vile{'s' * (i % 3)} grumble. {prose(i + 1, 30)}"
    rows = [(i, bad(i) if i % 4 == 0 else prose(i, 90)) for i in range(400)] + [(900, None), (901, ""), (902, "?!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(9))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [i for i in range(400) if got[i]["held_out"]]
    assert held == [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert all(got[i]["score"] == 0 and got[i]["predicted"] == 0 for i in (900, 901, 902))
    model = toxicity.fit(docs, labels)
    found = toxicity.locate(docs, model).collect()
    first = {}
    for r in found:
        first.setdefault(r["doc_id"], []).append(r["sentence_no"])
    assert {d: (r["n_offending"], r["first_offending"]) for d, r in got.items()} == {d: (len(first.get(d, [])), min(first[d]) if d in first else None) for d in got}
    assert found and all("vile" in r["sentence"] or "grumble" in r["sentence"] for r in found)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got.values())


def test_noisy_or():
    model = toxicity.Model(-2.0, {"^bad$": 3.0})
    p = [s for _, s in toxicity.sentence_scores(model, "a b. bad c! d")]
    assert p == pytest.approx([1 / (1 + math.exp(2)), 1 / (1 + math.exp(-1)), 1 / (1 + math.exp(2))])
    assert toxicity.document_score(model, "a b. bad c! d") == pytest.approx(1 - math.prod(1 - x for x in p))


def test_length_alone_is_not_toxic(spark, prose):
    rows = [(i, f"{prose(i, 50)}. You vile grumble. {prose(i + 1, 30)}" if i % 4 == 0 else prose(i, 90)) for i in range(200)]
    plain = ". ".join(prose(5000 + i, 4).replace(".", "") for i in range(20_000))
    rows += [(900, plain), (901, plain + ". You vile grumble.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert (got[900]["score"], got[900]["predicted"]) == (0, 0) and got[901]["predicted"] == 1


def test_training_reads_whole_texts(spark, prose, monkeypatch):
    late = lambda i: f"{prose(i, 9000)}. You vile grumble. {prose(i, 20)}"
    rows = [(i, late(i) if i % 4 == 0 else prose(i, 90)) for i in range(40)]
    assert min(len(t) for i, t in rows if i % 4 == 0) > 50_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    assert any("grumble" in f for f in toxicity.fit(docs, labels).weight)
    sample = toxicity.training_sample(docs, labels)
    whole = sorted(map(tuple, toxicity._document_counts(sample).collect()))
    monkeypatch.setattr(toxicity, "WIDE", 500)
    monkeypatch.setattr(toxicity, "HELD", 2000)
    assert sorted(map(tuple, toxicity._document_counts(sample).collect())) == whole


def test_rows_of_repeated_ids_are_sampled_in_a_fixed_order(spark):
    rows = [(7, f"text {i % 400}") for i in range(500)] + [(i, f"clean {i}") for i in range(8, 20)]
    schema = "doc_id long, text string"
    labels = spark.createDataFrame([(i, int(i == 7)) for i in range(7, 20)], "doc_id long, toxic int")
    got = [
        sorted(r["t"] for r in toxicity.training_sample(spark.createDataFrame(x, schema).repartition(n), labels, 20).collect())
        for x, n in ((rows, 2), (rows[::-1], 5))
    ]
    assert got[0] == got[1] and len(got[0]) == 60


def test_scores_equal_the_model_by_hand(spark, docs, prose):
    bad = [(6000 + i, f"{prose(i, 30)}. You vile grumble. {prose(i + 1, 10)}") for i in range(40)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(bad, "doc_id long, text string"))
    labels = spark.createDataFrame([(d, 1) for d, _ in bad] + [(i, 0) for i in range(60)] + [(3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(rows, labels)
    assert model.weight

    def by_hand(text):
        none = 1.0
        for sentence in re.split(r"[.!?\n]+", text or ""):
            words = re.findall(r"\w+", sentence.lower())
            own = [f for w in set(words) for f in toxicity.features(w) if f in model.weight]
            if own:
                none *= 1 - 1 / (1 + math.exp(-model.bias - sum(model.weight[f] for f in own)))
        return 1 - none

    got = sorted((str(r["doc_id"]), round(r["score"], 9), r["predicted"]) for r in toxicity.score(rows, labels).collect())
    want = sorted((str(r["doc_id"]), round(by_hand(r["text"]), 9), int(by_hand(r["text"]) >= 0.5)) for r in rows.collect())
    for a, b in zip(got, want):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-6) and a[2] == b[2]


def test_toxicity_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, none).count() == 0
