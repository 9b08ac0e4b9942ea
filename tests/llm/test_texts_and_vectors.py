"""Periodic runs, removal of earlier copies and whitening against plain versions."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import periodic_runs, substring_dedup, suffixes, whitening

BLANKS = str.maketrans("\t\n\x0b\x0c\r", "     ")


def plain_runs(words, min_length=12):
    """Every maximal run by trying all periods; the least period of each stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, 2 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_digest(doc_id, text):
    words = [w for w in (text or "").translate(BLANKS).split(" ") if w]
    n, h = len(words), crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, sha(lines), sha(text))


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def repetitive(spark, docs, prose):
    rng = random.Random(3)
    texts = ["tick tock " * 40, "a " * 500, "x", "one two three " * 4 + "one two", "q\x0bq\x0cq   q q\x1cq " * 9]
    for k in range(300):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 70))]
        cut = rng.randint(1, 9)
        texts.append(" ".join(words[:cut] * rng.randint(1, 6) + words[cut:]))
    texts.append(prose(99, 30) + " again and again" * 300 + prose(98, 9000))
    rows = [(10_000 + k, t) for k, t in enumerate(texts)] + [(None, texts[3])]
    return docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


def test_runs_equal_all_periods(repetitive):
    found = periodic_runs.find_runs(repetitive, order=periodic_runs.planted_order)
    got = sorted((tuple(r) for r in periodic_runs.digest(found).collect()), key=key)
    want = sorted((plain_digest(r["doc_id"], r["text"]) for r in repetitive.collect()), key=key)
    assert got == want
    assert sum(1 for r in want if r[1]) > 50


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_few_symbols(seed):
    rng = random.Random(seed)
    texts = [[rng.randint(0, rng.randint(0, 3)) for _ in range(rng.randint(1, 60))] for _ in range(3)]
    ends = np.cumsum([len(t) for t in texts])
    owner = np.repeat(np.arange(3), [len(t) for t in texts])
    symbols = owner * 10 + np.concatenate(texts)
    got = periodic_runs.runs_of(symbols, ends[owner], 2)
    base = [0, *ends]
    want = [(s + base[k], length, q) for k, t in enumerate(texts) for s, length, q in plain_runs(t, 2)]
    assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def test_blocks_do_not_change_runs(repetitive, monkeypatch):
    """In this process, since workers keep the module's own value."""
    import pyarrow as pa

    rows = repetitive.limit(150).collect()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    whole = periodic_runs._judge(batch.column(0), batch.column(1), None, 12)
    monkeypatch.setattr(periodic_runs, "BLOCK_BYTES", 200)
    parts = [periodic_runs._judge(b.column(0), b.column(1), None, 12) for b in periodic_runs._blocks(batch)]
    assert len(parts) > 10
    assert [x for p in parts for x in p[2].to_pylist()] == whole[2].to_pylist()
    assert [x for p in parts for x in p[3].to_pylist()] == whole[3].to_pylist()


@pytest.mark.parametrize("seed", range(20))
def test_nearest_smaller_and_previous_factors(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 80))
    v, lcp = rng.integers(0, 6, n), rng.integers(0, 9, n)
    after = [next((j for j in range(i + 1, n) if v[j] < v[i]), n) for i in range(n)]
    before = [next((j for j in range(i - 1, -1, -1) if v[j] < v[i]), -1) for i in range(n)]
    assert suffixes.next_smaller(v, np.arange(n)).tolist() == after
    assert suffixes.previous_smaller(v, np.arange(n)).tolist() == before
    want = [
        max(min(lcp[i + 1 : after[i] + 1]) if after[i] < n else 0, min(lcp[before[i] + 1 : i + 1]) if before[i] >= 0 else 0)
        for i in range(n)
    ]
    assert suffixes.previous_factors(v, lcp).tolist() == want


# --- earlier copies -------------------------------------------------------------------


def plain_removal(rows):
    """Every string of 50 bytes with the smallest id of a document in which it starts."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - 49) if doc is not None else ():
            w = data[s : s + 50]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 49) if doc is not None else ():
            if first[data[s : s + 50]] < doc:
                gone[s : s + 50] = b"\x01" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def copies(spark, docs, prose):
    rng = random.Random(5)
    passage, license = prose(500, 70), prose(501, 25)
    assert len(passage) > 200
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k in range(120):  # a third and more quote, with edges of their own
        a = rng.randrange(len(passage) - 120)
        quote = passage if k % 3 else passage[a : a + rng.choice([49, 50, 51, 60, 100])]
        rows.append((2000 - k, prose(600 + k, rng.randint(3, 30)) + quote + prose(800 + k, rng.randint(0, 30)) + license))
    rows += [(3000 + k, t) for k, t in enumerate(["z" * 49, "z" * 50, "z" * 500, "z" * 120 + "y" * 80, "ab" * 90, "é" * 60, "xé" * 40 + "é" * 60])]
    rows += [(3100, prose(900, 60)), (3100, prose(900, 60) + passage), (3101, prose(900, 40)), (None, passage), (4000, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows

def test_spans_are_united_across_batches():
    rng = random.Random(8)
    rows = sorted((rng.randint(0, 6), rng.randint(-1, 1), a, a + rng.randint(1, 30)) for a in (rng.randint(0, 400) for _ in range(900)))
    covered = defaultdict(set)
    for doc, text, a, b in rows:
        covered[doc, text].update(range(a, b))
    names = ["doc_id", "text_id", "from", "to"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + 37]]) for k in range(0, len(rows), 37)]
    near = list(substring_dedup._united(iter(batches)))
    assert sum(map(len, near)) < len(rows)
    got = {}
    for batch in substring_dedup._listed(iter(batches)):
        for r in batch.to_pylist():
            assert (r["doc_id"], r["text_id"]) not in got
            got[r["doc_id"], r["text_id"]] = [(x["from"], x["to"]) for x in r["spans"]]
    want = {k: [] for k in covered}
    for k, places in covered.items():
        for p in sorted(places):
            if want[k] and want[k][-1][1] == p:
                want[k][-1] = (want[k][-1][0], p + 1)
            else:
                want[k].append((p, p + 1))
    assert got == want


@pytest.mark.parametrize("hot", [substring_dedup.HOT_SEGMENTS, 0])
def test_removal_equals_all_strings(copies, hot):
    df, rows = copies
    done = substring_dedup.remove_later_copies(df, hot_segments=hot)
    got = sorted((tuple(r) for r in substring_dedup.digest(done).collect()), key=key)
    want = sorted(plain_removal(rows), key=key)
    assert got == want
    assert sum(1 for r in want if r[2]) > 100


def test_spans_and_kept_bytes_make_up_the_text(copies):
    df, rows = copies
    left = defaultdict(list)
    for doc, text in rows:
        left[doc].append((text or "").encode())
    for r in substring_dedup.remove_later_copies(df).collect():
        assert r["n_bytes"] == len(r["kept"]) + sum(s["length"] for s in r["removed"])
        def cut(data):
            at, out = 0, b""
            for s in r["removed"]:
                out, at = out + data[at : s["start"]], s["start"] + s["length"]
            return out + data[at:]
        assert any(cut(data) == bytes(r["kept"]) for data in left[r["doc_id"]] if len(data) == r["n_bytes"])


@pytest.mark.parametrize("seed", range(10))
def test_window_order(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    data[100:250] = data[0:150]
    at = rng.permutation(350)
    order, lcp = substring_dedup.window_order(data, at)
    cut = [data[a : a + 50].tobytes() for a in at[order]]
    assert cut == sorted(cut)
    shared = [next((k for k in range(50) if a[k] != b[k]), 50) for a, b in zip(cut, cut[1:])]
    assert lcp.tolist() == [0, *shared]


def test_segments_hold_every_window_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 49, 50, 51, 400, 3, 90)] + [np.full(300, 97, np.uint8)]
    lengths = np.array([len(t) for t in texts])
    h, start, size, anchor = substring_dedup.segments(np.concatenate(texts), lengths)
    got = sorted(s + k for s, n in zip(start.tolist(), size.tolist()) for k in range(n))
    base = np.cumsum(lengths) - lengths
    assert got == [b + k for b, n in zip(base.tolist(), lengths.tolist()) for k in range(n - 49)]
    assert size.max() <= substring_dedup.SPAN
    # Anchor and hash of a window are those of its text alone.
    data, seen = np.concatenate(texts), {}
    for x, s, n, a in zip(h.tolist(), start.tolist(), size.tolist(), anchor.tolist()):
        for k in range(n):
            assert seen.setdefault(data[s + k : s + k + 50].tobytes(), (x, a - s - k)) == (x, a - s - k)
            assert 0 <= a - s - k <= 26


# --- whitening ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(40))
def test_rank_one_update(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 12))
    values = rng.random(d) * 10.0 ** rng.integers(-8, 8)
    if seed % 3 == 0:
        values[: d // 2] = values[0]  # deflated by reflection
    values = np.sort(values)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    v = q[:, 0] * 3 if seed % 4 == 0 else rng.normal(size=d) * 10.0 ** rng.integers(-5, 5)
    a = q @ np.diag(values) @ q.T + 0.7 * np.outer(v, v)
    new, basis = whitening.rank_one(values, q, 0.7, v)
    assert np.abs(basis @ np.diag(new) @ basis.T - a).max() <= 1e-11 * np.abs(a).max()
    assert np.abs(basis.T @ basis - np.eye(d)).max() < 1e-12
    assert (np.diff(new) >= 0).all()


def test_spectra_combine():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(90, 9)) * np.linspace(1, 100, 9))
    x[20:40] = x[0]
    sides = [whitening.Spectrum(9) for _ in range(4)]
    for k, row in enumerate(x):
        sides[k % 3].add(row)
    whole = sides[3]
    for side in sides[:3]:
        whole.absorb(whitening.Spectrum.of_row(np.array(side.row()), 9))
    want = np.cov(x.T, bias=True) * 90
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - want).max() < 1e-9 * np.abs(want).max()
    assert np.allclose(whole.mean, x.mean(axis=0))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(k, [float(c) for c in rng.normal(size=12) * np.linspace(0.01, 0.3, 12)]) for k in range(400)]
    rows += [rows[5], (None, rows[6][1]), (900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] * 12)]
    rows += [(904, [1.0] * 5), (905, []), (906, [1e300] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "'x' as whitened")
    return frame.repartition(7), rows


def test_whitening_equals_dense_eigenvectors(vectors):
    df, rows = vectors
    sound = [(k, v) for k, v in rows if v and len(v) == 12 and all(c is not None and abs(c) < 1e200 for c in v)]
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in sound], np.int64)
    n = len(x)
    cov = np.cov((x - 100_000).T.astype(float), bias=True)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    want = (x - x.sum(axis=0) / n) @ q[:, :8] / np.sqrt(e[:8])
    got = whitening.whiten(df).collect()
    assert len(got) == 8 * n and sorted({r["component"] for r in got}) == list(range(1, 9))
    places = defaultdict(list)
    for k, (doc, _) in enumerate(sound):
        places[doc].append(k)
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    sign = {}
    for r in sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"], r["component"])):
        k, c = places[r["vec_id"]][0], r["component"] - 1
        s = sign.setdefault(c, np.sign(r["whitened"] * want[k, c]))
        assert abs(r["whitened"] - s * want[k, c]) < 1e-9
        assert r["n"] == n and r["deviation"] == int(deviation[k])
        assert abs(r["explained"] / (e[c] / e.sum()) - 1) < 1e-10
        assert r["identity_error"] < 1e-10


def test_whitening_of_few_and_equal_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], kind)
    one = spark.createDataFrame([(1, [0.5, 0.25])], kind)
    equal = spark.createDataFrame([(k, [0.5, 0.25]) for k in range(9)], kind)
    for df in (none, one, equal):
        assert whitening.whiten(df).collect() == []
    two = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.25, 0.5])], kind)
    assert sorted(abs(round(r["whitened"], 9)) for r in whitening.whiten(two).collect()) == [1.0, 1.0]


def test_empty_documents(empty):
    assert periodic_runs.digest(periodic_runs.find_runs(empty)).collect() == []
    assert substring_dedup.digest(substring_dedup.remove_later_copies(empty)).collect() == []
