"""Language identification with a bidirectional gated recurrent network.

The network reads UTF-8 bytes. Each direction is a gated recurrent layer of
``HIDDEN`` units whose one gate both resets the recurrent input of the
candidate state and mixes the candidate into the state. Every byte position
gets a softmax over the languages from the two states at that position, and a
document's probabilities are the mean over all its positions. The network is
trained in numpy by backpropagation through time, on a bounded sample.

Both directions read a text from end to end: the forward state at a byte depends on
every byte before it, the backward state on every byte behind it. To run many bytes at
once, texts are cut into windows of ``WINDOW`` bytes that advance as one batch from a
guessed start state. A window whose start differs from the state in which its neighbour
ends is run again from that state, until it meets what it had before, and so on until
every window starts where its neighbour ends. What is found does therefore not depend on
``WINDOW`` or ``BLOCK`` (up to ``SAME``), and memory per block is fixed whatever the
length of a text: of a text of more than ``BLOCK`` windows the backward states at the
edges of blocks are found first.

Training reads whole sampled texts, in pieces of ``STEPS`` bytes through which errors are
propagated back.

Defined results. Null text, empty text and text without a letter: language
``und``, score 0. No labelled text in the training part: ``und``, score 0 for
every document. Repeated rows: judged each. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import hash_edge, held_out, sample_order

HIDDEN = 8
WINDOW = 128
BLOCK = 4096  # windows per batch of the network
SAME = 1e-5  # states that differ by less are equal
STEPS = 64  # bytes through which errors are propagated back
BATCH = 256  # pieces per step of the training
#: The bound of the training sample: about this many whole texts of each language.
SAMPLE_PER_LANGUAGE = 200


@dataclass
class ByteGru:
    """Weights of the network; ``p`` maps names to float32 arrays."""

    languages: list[str]
    p: dict[str, np.ndarray]


def _initial(n_lang: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {}
    for d in "fb":
        p[f"xg{d}"] = rng.normal(0, 0.3, (256, HIDDEN))
        p[f"xc{d}"] = rng.normal(0, 0.3, (256, HIDDEN))
        p[f"ug{d}"] = rng.normal(0, 0.3, (HIDDEN, HIDDEN))
        p[f"uc{d}"] = rng.normal(0, 0.3, (HIDDEN, HIDDEN))
        p[f"o{d}"] = rng.normal(0, 0.3, (HIDDEN, n_lang))
    p["bias"] = np.zeros(n_lang)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _cell(p: dict[str, np.ndarray], d: str):
    """A function from the state and the bytes read to gate, recurrent input, candidate
    and new state of one direction."""
    ug, uc, xg, xc = p[f"ug{d}"] * np.float32(0.5), p[f"uc{d}"], p[f"xg{d}"] * np.float32(0.5), p[f"xc{d}"]

    def step(h: np.ndarray, x: np.ndarray):
        g = h @ ug
        g += xg.take(x, axis=0)
        np.tanh(g, out=g)
        g += 1
        g *= 0.5  # the logistic function of twice the sum above
        r = h @ uc
        c = g * r
        c += xc.take(x, axis=0)
        np.tanh(c, out=c)
        new = c - h
        new *= g
        new += h
        return g, r, c, new

    return step


def _states(p: dict[str, np.ndarray], d: str, x: np.ndarray, keep: list) -> np.ndarray:
    """States of one direction for pieces ``x`` of shape (steps, batch), each from zero;
    what the gradients need is added to ``keep``."""
    steps, batch = x.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    step = _cell(p, d)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        g, r, c, new = step(h, x[t])
        keep.append((t, h, g, r, c))
        h = out[t] = new
    return out


def _linked_states(p, d: str, x: np.ndarray, size: np.ndarray, link: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """States of one direction for windows ``x`` of shape (window, n) in text order.

    Window i has ``size[i]`` bytes and goes on with the text of window i - 1 where
    ``link[i]``. ``edge`` is the state in which the first (forward) or last (backward)
    window starts; any other window starts where its neighbour ends, and the first or
    last window of a text from zero.
    """
    window, n = x.shape
    ahead = d == "f"
    order = range(window) if ahead else range(window - 1, -1, -1)
    step = _cell(p, d)
    out = np.empty((window, n, HIDDEN), np.float32)
    start = np.zeros((n, HIDDEN), np.float32)
    start[0 if ahead else -1] = edge
    opens = {s - 1: np.flatnonzero(size == s) for s in np.unique(size[size < window]).tolist()}
    h = start
    for t in order:
        if not ahead and t in opens:  # the last byte of these texts
            h[opens[t]] = start[opens[t]]
        h = out[t] = step(h, x[t])[3]
    while True:
        want = start.copy()
        if ahead:
            want[1:][link[1:]] = out[-1, :-1][link[1:]]
        else:
            want[:-1][link[1:]] = out[0, 1:][link[1:]]
        rows = np.flatnonzero(np.abs(want - start).max(axis=1) > SAME)
        if not len(rows):
            return out
        start[rows] = want[rows]
        h, part = want[rows], np.ascontiguousarray(x[:, rows])
        for k, t in enumerate(order):
            h = step(h, part[t])[3]
            if k % 8 == 7:
                moved = np.abs(h - out[t, rows]).max(axis=1) > SAME
                out[t, rows] = h
                if not moved.all():
                    rows, h, part = rows[moved], h[moved], np.ascontiguousarray(part[:, moved])
                    if not len(rows):
                        break
            else:
                out[t, rows] = h


def _position_probabilities(p: dict[str, np.ndarray], hf: np.ndarray, hb: np.ndarray) -> np.ndarray:
    z = hf @ p["of"]
    z += hb @ p["ob"]
    z += p["bias"]
    z -= z.max(axis=-1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=-1, keepdims=True)
    return z


def _gradients(p, x, mask, y):
    """Loss and gradients of the mean position-wise cross-entropy."""
    kept: dict[str, list] = {"f": [], "b": []}
    states = {d: _states(p, d, x, kept[d]) for d in "fb"}
    prob = _position_probabilities(p, states["f"], states["b"])
    steps, batch = x.shape
    total = mask.sum()
    rows = np.arange(batch)
    loss = -(np.log(prob[:, rows, y] + 1e-9) * mask).sum() / total
    dz = prob
    dz[:, rows, y] -= 1
    dz *= (mask / total)[:, :, None]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["bias"] = dz.sum((0, 1))
    for d in "fb":
        g[f"o{d}"] = np.einsum("tbh,tbl->hl", states[d], dz)
        dh_out = dz @ p[f"o{d}"].T
        back = np.zeros((batch, HIDDEN), np.float32)
        for t, h, gate, r, c in reversed(kept[d]):
            dh = dh_out[t] + back
            dc = dh * gate * (1 - c * c)
            dg = (dh * (c - h) + dc * r) * gate * (1 - gate)
            dr = dc * gate
            back = dh * (1 - gate) + dg @ p[f"ug{d}"].T + dr @ p[f"uc{d}"].T
            g[f"ug{d}"] += h.T @ dg
            g[f"uc{d}"] += h.T @ dr
            np.add.at(g[f"xg{d}"], x[t], dg)
            np.add.at(g[f"xc{d}"], x[t], dc)
    return loss, g


def train(texts: list[str], labels: list[str], seed: int = 7) -> ByteGru:
    """Fit the network on whole labelled texts with Adam; every piece of them is read at
    least once, those of rare languages as often as makes all languages weigh the same."""
    languages = sorted(set(labels))
    y_all = np.array([languages.index(v) for v in labels])
    rng = np.random.default_rng(seed)
    p = _initial(len(languages), rng)
    raws = [t.encode() for t in texts]
    pieces = [max(1, -(-len(r) // STEPS)) for r in raws]
    ys = np.repeat(y_all, pieces)
    x_all = np.frombuffer(b"".join(r.ljust(k * STEPS, b"\0") for r, k in zip(raws, pieces)), np.uint8).reshape(-1, STEPS)
    size = np.concatenate([np.minimum(STEPS, len(r) - STEPS * np.arange(k)) for r, k in zip(raws, pieces)])
    counts = np.bincount(ys, minlength=len(languages))
    order_pool = np.concatenate([np.resize(np.flatnonzero(ys == k), counts.max()) for k in range(len(languages))])
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    whole = -(-len(order_pool) // BATCH)  # steps in which every piece is read once
    n, planned = 0, max(60, whole, min(240, 3 * whole))
    while n < planned:
        order = rng.permutation(order_pool)
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            mask = (np.arange(STEPS)[:, None] < size[pick]).astype(np.float32)
            if not mask.any():
                continue
            _, g = _gradients(p, x_all[pick].T.copy(), mask, ys[pick])
            n += 1
            rate = 0.02 * (1 - 0.9 * n / planned)
            for name in p:
                grad = np.clip(g[name], -1, 1)
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.99 * v[name] + 0.01 * grad * grad
                step = (m[name] / (1 - 0.9**n)) / (np.sqrt(v[name] / (1 - 0.99**n)) + 1e-8)
                p[name] = (p[name] - rate * step).astype(np.float32)
            if n >= planned:
                break
    return ByteGru(languages, p)


def _label_block(model: ByteGru, raws: list[bytes], window: int, front: np.ndarray, back: np.ndarray):
    """Position probabilities (window, n, languages), the mask of positions that are
    bytes, the text that each window belongs to, and the forward state at the end."""
    number = [-(-len(r) // window) for r in raws]
    x = np.frombuffer(b"".join(r.ljust(k * window, b"\0") for r, k in zip(raws, number)), np.uint8)
    x = np.ascontiguousarray(x.reshape(-1, window).T)
    owner = np.repeat(np.arange(len(raws)), number)
    size = np.concatenate([np.minimum(window, len(r) - window * np.arange(k)) for r, k in zip(raws, number)])
    link = np.r_[False, owner[1:] == owner[:-1]]
    hf = _linked_states(model.p, "f", x, size, link, front)
    hb = _linked_states(model.p, "b", x, size, link, back)
    prob = _position_probabilities(model.p, hf, hb)
    return prob, np.arange(window)[:, None] < size, owner, hf[-1, -1].copy()


def _label(model: ByteGru, raws: list[bytes], window: int, block: int):
    """(texts, probabilities, mask, owner) per block of at most ``block`` windows; ``texts``
    are the positions in ``raws`` that ``owner`` counts."""
    zero = np.zeros(HIDDEN, np.float32)
    held, windows = [], 0
    for i, raw in enumerate(raws):
        need = -(-len(raw) // window)
        if held and windows + need > block:
            yield held, *_label_block(model, [raws[j] for j in held], window, zero, zero)[:3]
            held, windows = [], 0
        if need > block:
            cuts = [raw[k : k + block * window] for k in range(0, len(raw), block * window)]
            backs = [zero]
            for cut in reversed(cuts[1:]):
                backs.append(_first_backward(model, cut, window, backs[-1]))
            front = zero
            for cut, back in zip(cuts, reversed(backs)):
                *found, front = _label_block(model, [cut], window, front, back)
                yield [i], *found
        elif need:
            held.append(i)
            windows += need
    if held:
        yield held, *_label_block(model, [raws[j] for j in held], window, zero, zero)[:3]


def _first_backward(model: ByteGru, raw: bytes, window: int, back: np.ndarray) -> np.ndarray:
    """The backward state at the first byte of ``raw``, ``back`` being that behind it."""
    number = -(-len(raw) // window)
    x = np.frombuffer(raw.ljust(number * window, b"\0"), np.uint8).reshape(-1, window)
    size = np.minimum(window, len(raw) - window * np.arange(number))
    link = np.arange(number) > 0
    return _linked_states(model.p, "b", np.ascontiguousarray(x.T), size, link, back)[0, 0].copy()


def position_probabilities(model: ByteGru, text: str, window: int = WINDOW, block: int = BLOCK) -> np.ndarray:
    """(bytes, languages): the label distribution at every byte of one text."""
    parts = [prob.transpose(1, 0, 2)[own.T] for _, prob, own, _ in _label(model, [text.encode()], window, block)]
    return np.concatenate(parts) if parts else np.zeros((0, len(model.languages)))


def pooled(model: ByteGru, raws: list[bytes], window: int = WINDOW, block: int = BLOCK) -> np.ndarray:
    """(texts, languages): the mean of the position probabilities of each text."""
    total = np.zeros((len(raws), len(model.languages)))
    for texts, prob, own, owner in _label(model, raws, window, block):
        np.add.at(total, np.array(texts)[owner], np.einsum("tbl,tb->bl", prob, own))
    return total / np.maximum(1, [[len(r)] for r in raws])


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list:
    """Rows (lang, text): about ``per_language`` whole texts of each language.

    Only the training part is read. The bound on the sample is ``2 * per_language``
    labelled rows per language; every language has its share.
    """
    pool = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    counts = pool.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    if not counts:
        return []
    chosen = F.lit(False)
    for row in counts:
        share = min(1.0, 1.5 * per_language / row["count"])
        chosen |= (F.col("lang") == row["lang"]) & (F.col("o") <= hash_edge(share))
    ordered = pool.select("lang", sample_order("doc_id").alias("o"), "text")
    picked = ordered.where(chosen & F.col("text").rlike(r"\p{L}"))
    return picked.orderBy("o", "lang", "text").limit(2 * per_language * len(counts)).collect()


def detect(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = batch.column(2)
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            if net is not None:
                some = [i for i, t in enumerate(texts) if t.is_valid and any(map(str.isalpha, t.as_py()))]
                prob = pooled(net, [texts[i].as_py().encode() for i in some])
                for i, row in zip(some, prob):
                    k = int(row.argmax())
                    lang[i], score[i] = net.languages[k], min(1.0, float(row[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    given = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return given.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Train on the training part of ``docs`` and label every document."""
    rows = training_sample(docs, per_language)
    texts, labels = [r["text"] for r in rows], [r["lang"] for r in rows]
    return detect(docs, train(texts, labels) if texts else None)
