"""The trees of the URL filter against plain Python: features, suffix rates and boosting."""

import math
import random
import re
from collections import Counter

import numpy as np

from orrery.llm import url_filter


def made_urls(seed: int, n: int = 30) -> list[tuple[str, int]]:
    """Labelled urls of many shapes; blocked ones are longer and hold more digits, mostly."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl-") for _ in range(rng.randint(2, 9)))
    out = []
    for i in range(n):
        bad = int(rng.random() < 0.45)
        host = ".".join([word() for _ in range(rng.randint(1, 3))] + [rng.choice(["com", "NET", "org", "xyz"][bad:])])
        path = "".join("/" + word() for _ in range(rng.randint(0, 3)))
        path += str(rng.randrange(10 ** rng.randint(1, 4 + 5 * bad))) if rng.random() < 0.7 else ""
        port = ":8080" if rng.random() < 0.1 else ""
        args = "?" + "&".join(f"{word()}={word()}" for _ in range(rng.randint(1, 3))) if rng.random() < 0.4 else ""
        out.append((rng.choice(["http", "https"]) + "://" + host + port + path + args + ("#Ä_%" if i % 7 == 0 else ""), bad))
    return out


def plain_features(url: str | None) -> tuple[str, str, list[float]]:
    """Both suffixes and the lexical features, in the order of FEATURES."""
    u = url or ""
    at = u.find("://")
    rest = u[at + 3 :] if at >= 0 else ""
    raw = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(raw) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    labels = re.sub(r":[0-9]*$", "", host).split(".")
    digits = lambda s: sum(c in "0123456789" for c in s) / max(1, len(s))
    bits = -sum(k / len(u) * math.log2(k / len(u)) for k in Counter(u).values())
    return labels[-1], ".".join(labels[-2:]) if len(labels) > 1 else "", [
        len(u), len(host), len(path), path.count("/"), host.count("."), digits(u), digits(host), bits,
        len(re.findall("[?&][^=&]*=", u)), host.count("-"), sum(c in "%_~@" for c in u), "#" in u, u.startswith("https"),
    ]


def plain_rows(urls: list[tuple[str, int]]) -> np.ndarray:
    """Training rows: the label and all features, a url's own label left out of its rates."""
    base = sum(y for _, y in urls) / len(urls)
    found = [(*plain_features(u), y) for u, y in urls]
    rows = []
    for last, two, lexical, y in found:
        rates = []
        for k, own in enumerate((last, two)):
            same = [f[3] for f in found if f[k] == own]
            rates.append((sum(same) - y + url_filter.SMOOTH * base) / (len(same) - 1 + url_filter.SMOOTH))
        rows.append([y, *lexical, *rates, sum(f[0] == last for f in found) / len(found)])
    return np.array(rows, float)


def grown(x: np.ndarray, t: np.ndarray, depth: int) -> np.ndarray:
    """What a variance-reducing tree says of its own rows; no two different best splits may tie."""
    fitted = np.full(len(t), t.mean())
    if depth == 0 or t.var() < 1e-15:
        return fitted
    gains: dict[bytes, float] = {}
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, j] <= cut
            part = (left if left[0] else ~left).tobytes()
            gains[part] = t.var() - left.mean() * t[left].var() - (~left).mean() * t[~left].var()
    order = sorted(gains, key=gains.get, reverse=True)
    if not order or gains[order[0]] <= 1e-12:
        return fitted
    assert len(order) == 1 or gains[order[0]] - gains[order[1]] > 1e-9, "tied splits"
    left = np.frombuffer(order[0], bool)
    fitted[left], fitted[~left] = grown(x[left], t[left], depth - 1), grown(x[~left], t[~left], depth - 1)
    return fitted


def boosted(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Probabilities of label 1 after gradient boosting of the log loss, steps of 0.1."""
    y = 2 * label - 1
    margin = grown(x, y, url_filter.DEPTH)
    for _ in range(url_filter.TREES - 1):
        margin = margin + 0.1 * grown(x, 4 * y / (1 + np.exp(2 * y * margin)), url_filter.DEPTH)
    return 1 / (1 + np.exp(-2 * margin))


def test_training_rows_and_trees_match_plain_python(spark, monkeypatch):
    urls = made_urls(3)  # no two different splits tie in it
    kept, fit = [], url_filter.GBTClassifier.fit

    def fitted(self, rows):
        model = fit(self, rows)
        kept.extend(model.transform(rows).select("label", "features", "probability").collect())
        return model

    monkeypatch.setattr(url_filter.GBTClassifier, "fit", fitted)
    labelled = spark.createDataFrame(urls, "url string, label int")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = url_filter.classify(pages, labelled).collect()
    assert len(got) == len(kept) == len(urls)
    rows = np.array([[r["label"], *r["features"].toArray()] for r in kept])
    order = lambda a: a[np.lexsort(a.round(9).T)]
    assert np.allclose(order(rows), order(plain_rows(urls)), atol=1e-9)
    p = np.array([r["probability"][1] for r in kept])
    assert np.allclose(p, boosted(rows[:, 1:], rows[:, 0]), atol=1e-6)
    assert all(r["verdict"] == ("block" if r["p_block"] >= 0.5 else "allow") for r in got)


def test_lexical_features_of_odd_urls(spark):
    odd = [None, "", "://", "no scheme", "x://h://p", "http://h.com:80/A?b=c&&d=#e=f", "HTTPS://Ü.COM/ß?x=日本", "http://" + "a.b-" * 5000 + "com/" + "9/" * 9000]
    df = spark.createDataFrame(list(enumerate(odd)) + [(5, odd[5])], "page_id long, url string")
    names = url_filter.FEATURES[:13]
    got = url_filter.lexical(df, "page_id").select("page_id", "last", "two", *names).collect()
    assert len(got) == len(odd) + 1
    for r in got:
        last, two, want = plain_features(odd[r["page_id"]])
        assert (r["last"], r["two"]) == (last, two)
        assert np.allclose([r[n] for n in names], np.array(want, float), atol=1e-9), odd[r["page_id"]]
