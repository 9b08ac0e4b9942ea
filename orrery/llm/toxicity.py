"""Toxicity by multiple-instance learning over sentences.

A document is a bag of sentences and only the bag has a label. A sentence's
probability is logistic in the features that it holds, and 0 without any, so
that length alone is no evidence; a document's is the noisy-or of its
sentences, 1 - prod(1 - p). Training follows the gradient of
the document's log-likelihood through the noisy-or, so a sentence is blamed in
the measure in which it explains the label, and afterwards sentences can be
scored alone: ``locate`` names the offending ones.

Features are words and the character n-grams of words, marked at both ends, so
that stems are learned too. A feature may carry weight if it occurs in at least
MIN_TOXIC and a share MIN_SHARE of the toxic training documents, and its share
there is at least MIN_LIFT times that among the others (one document added, so
that rare features do not pass by chance). Training uses a bounded
sample of labelled rows; it and scoring read whole texts.

Defined results. Null, empty or wordless text: no sentences, score 0. No
labels or a single class: an empty model, score 0 for all. A document with
contradicting labels counts as toxic. Repeated rows are judged each, extra
columns, of any name, are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import fresh, held_out, materialise, sample_order

#: Training documents per class at most; each is read whole.
SAMPLE_PER_CLASS = 2000
#: Features of one text, and counted features of one task, that are held at once.
WIDE, HELD = 100_000, 1_000_000
MIN_TOXIC, MIN_SHARE, MIN_LIFT = 3, 0.02, 15.0
NGRAMS = range(4, 9)
MAX_FEATURES = 5_000
MEMO_WORDS = 100_000
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    bias: float
    weight: dict[str, float]
    #: Logit of a sentence that holds no feature; the bias if None.
    plain: float | None = None


class _WordWeights(dict):
    """word -> sum of the weights of its features, None if it has none; bounded."""

    def __init__(self, model: Model):
        super().__init__()
        self.weight = model.weight

    def __missing__(self, word: str) -> float | None:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = [self.weight[f] for f in features(word) if f in self.weight]
        total = self[word] = sum(found) if found else None
        return total


def features(word: str) -> set[str]:
    """A lower-case word as it is, between marks, and the n-grams of that."""
    marked = f"^{word}$"
    return {marked, *(marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1))}


def sentences(text: str) -> list[str]:
    """The sentences of a text that hold a word."""
    return [s for s in _SENTENCE.findall(text) if _WORD.search(s)]


def _document_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of either class that hold a feature.

    A text with more than WIDE features hands them over in parts, under its
    number, and they are made distinct by Spark; so a task's memory is bounded.
    """
    wide, held = WIDE, HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has: tuple[Counter, Counter] = (Counter(), Counter())

        def rows(names: list[str], doc: int | None, toxic: list[int], clean: list[int]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(names), 50_000):
                part = slice(k, k + 50_000)
                n = len(names[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[part], pa.string()), pa.array([doc] * n, pa.int64()), *[pa.array(x[part], pa.int64()) for x in (toxic, clean)]],
                    names=["feature", "doc", "toxic", "clean"],
                )

        def counted() -> Iterator[pa.RecordBatch]:
            names = list(has[0].keys() | has[1].keys())
            yield from rows(names, None, [has[1][f] for f in names], [has[0][f] for f in names])
            has[0].clear()
            has[1].clear()

        for batch in batches:
            for text, label, number in zip(batch.column(0), batch.column(1), batch.column(2)):
                y, doc = label.as_py(), number.as_py()
                own: set[str] = set()
                parted = False
                for s in sentences(text.as_py().lower()):
                    own.update(*map(features, set(_WORD.findall(s))))
                    if len(own) > wide:
                        yield from rows(list(own), doc, [y] * len(own), [1 - y] * len(own))
                        own.clear()
                        parted = True
                if parted:
                    yield from rows(list(own), doc, [y] * len(own), [1 - y] * len(own))
                else:
                    has[y].update(own)
                if len(has[0]) + len(has[1]) > held:
                    yield from counted()
        yield from counted()

    found = sample.select("t", "toxic", "n").mapInArrow(run, "feature string, doc long, toxic long, clean long")
    # Rows of counts have no doc; those of a parted text may repeat, and count once.
    once = found.groupBy("feature", "doc").agg(
        *[F.when(F.col("doc").isNull(), F.sum(c)).otherwise(F.max(c)).alias(c) for c in ("toxic", "clean")]
    )
    return once.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def select_features(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Features that may carry weight; at most MAX_FEATURES, the most telling first."""
    counts = _document_counts(sample).where(
        (F.col("toxic") >= max(MIN_TOXIC, MIN_SHARE * n_toxic))
        & (F.col("toxic") * n_clean >= MIN_LIFT * n_toxic * (F.col("clean") + 1))
    )
    return [r["feature"] for r in counts.orderBy(F.desc("toxic"), "feature").limit(MAX_FEATURES).collect()]


def bags(sample: DataFrame, chosen: list[str]) -> list:
    """Rows (toxic, sentences, times): each document's different sets of chosen features
    in a sentence, as the features' numbers, and how many sentences hold each set."""
    place = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(chosen)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            found, times = [], []
            for text in batch.column(0):
                full: Counter = Counter()
                for s in sentences(text.as_py().lower()):
                    ids: set[int] = set()
                    for w in set(_WORD.findall(s)):
                        if w not in known:
                            if len(known) >= MEMO_WORDS:
                                known.clear()
                            known[w] = [place.value[f] for f in features(w) if f in place.value]
                        ids.update(known[w])
                    if ids:
                        full[tuple(sorted(ids))] += 1
                found.append(list(full.keys()))
                times.append(list(full.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.list_(pa.int32()))), pa.array(times, pa.list_(pa.int32()))],
                names=["toxic", "sentences", "times"],
            )

    return sample.select("t", "toxic").mapInArrow(run, "toxic int, sentences array<array<int>>, times array<int>").collect()


def train(rows: list, chosen: list[str], steps: int = 300, decay: float = 1e-3) -> Model | None:
    """Fit weights to the labels of bags; None if there is but one class.

    Sentences without a chosen feature have probability 0 and are not in the bags.
    """
    y = np.array([r["toxic"] for r in rows], dtype=float)
    n1, n0 = y.sum(), len(y) - y.sum()
    if not n1 or not n0:
        return None
    doc = np.array([d for d, r in enumerate(rows) for _ in r["sentences"]], int)
    flat = [s for r in rows for s in r["sentences"]]
    times = np.array([n for r in rows for n in r["times"]], float)
    row = np.repeat(np.arange(len(flat)), [len(s) for s in flat]) if flat else np.zeros(0, int)
    col = np.array([i for s in flat for i in s], int)
    w, b = np.zeros(len(chosen)), -5.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    balance = np.where(y == 1, min(5.0, max(1.0, n0 / n1)), 1.0)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(row, w[col], minlength=len(doc)))))
        log_none = np.bincount(doc, times * np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        none = np.exp(log_none)
        # d loss / d z of a sentence: p in a clean document, -p (1 - P) / P in a toxic one.
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * balance
        dz = times * p * pull[doc]
        g = np.append(np.bincount(col, dz[row], minlength=len(chosen)) / len(y) + decay * w / len(y) ** 0.5, dz.sum() / len(y))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, b = w - step[:-1], min(-2.0, b - step[-1])
    # Every chosen feature stays, whatever its weight: it tells which sentences count.
    return Model(float(b), {x: float(a) for x, a in zip(chosen, w)}, -math.inf)


def sentence_scores(model: Model, text: str, memo: _WordWeights | None = None) -> list[tuple[str, float]]:
    """Every sentence of a text with its probability."""
    memo = memo if memo is not None else _WordWeights(model)
    out = []
    for s in _SENTENCE.findall(text):
        if words := _WORD.findall(s.lower()):
            found = [x for x in map(memo.__getitem__, set(words)) if x is not None]
            z = model.bias + sum(found) if found or model.plain is None else model.plain
            out.append((s, 1 / (1 + math.exp(-z)) if z > -700 else 0.0))
    return out


def noisy_or(scores: list[float]) -> float:
    return 1 - math.exp(sum([math.log1p(-min(p, 1 - 1e-12)) for p in scores]))


def document_score(model: Model | None, text: str | None, memo: _WordWeights | None = None) -> float:
    """The noisy-or of the sentences' probabilities."""
    if model is None or not text:
        return 0.0
    return noisy_or([p for _, p in sentence_scores(model, text, memo)])


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(t, toxic, n): whole texts of at most ``per_class`` ids of each class from the
    training part, with a number.

    The ids are chosen first, so the texts are read in one filtered scan. Where ids
    repeat, three rows an id are taken on average at most, by a fixed order of id and
    text. The table is written in small parts, as feature counting needs memory per text.
    """
    y = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0))
    y = y.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = [y.where(F.col("toxic") == k).orderBy(sample_order("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    ids = materialise(ids[0].unionByName(ids[1]), "toxic-sample")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").alias("t"))
    found = texts.join(F.broadcast(ids), "doc_id").select(
        "t", "toxic", sample_order("doc_id", "t").alias("k"), F.monotonically_increasing_id().alias("n")
    )
    found = materialise(found, "toxic-rows")
    bound = 3 * per_class
    if found.count() > bound:
        last = found.select("k", "n").orderBy("k", "n").limit(bound).agg(F.max(F.struct("k", "n")).alias("last")).first()["last"]
        found = found.where((F.col("k") < last["k"]) | (F.col("k") == last["k"]) & (F.col("n") <= last["n"]))
    return materialise(found.repartition(32, F.xxhash64("k", "n")).select("t", "toxic", "n"), "toxic-texts")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Choose features and fit weights; texts stay on the executors."""
    sample = training_sample(docs, labels, per_class)
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    chosen = select_features(sample, n[1], n[0])
    return train(bags(sample, chosen), chosen)


def with_score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` with the document score as a further column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordWeights(shared.value) if shared.value else None
        for batch in batches:
            s = [document_score(shared.value, t.as_py(), memo) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, and what
    ``locate`` finds in it: n_offending, the sentences at 0.5 or more, and
    first_offending, the number of the first of them (null if there is none)."""
    model = fit(docs, labels, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        memo = _WordWeights(net) if net else None
        for batch in batches:
            total, count, first = [], [], []
            for t in batch.column(1):
                each = [p for _, p in sentence_scores(net, t.as_py(), memo)] if net and t.is_valid else []
                bad = [k for k, p in enumerate(each) if p >= 0.5]
                total.append(noisy_or(each))
                count.append(len(bad))
                first.append(bad[0] if bad else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.float64()), pa.array(count, pa.int64()), pa.array(first, pa.int32())],
                names=["doc_id", "score", "n_offending", "first_offending"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, n_offending long, first_offending int")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_offending",
        "first_offending",
    )


def locate(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, sentence_no, sentence, score) of every sentence at 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, t in zip(batch.column(0), batch.column(1)):
                found = sentence_scores(shared.value, t.as_py()) if t.is_valid else []
                out += [(i.as_py(), k, s, p) for k, (s, p) in enumerate(found) if p >= 0.5]
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64())],
                names=["doc_id", "sentence_no", "sentence", "score"],
            )

    schema = f"doc_id {kind.simpleString()}, sentence_no int, sentence string, score double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    mark = fresh("_toxic_score", docs.columns)
    return with_score(docs, fit(docs, labels), mark).where(F.col(mark) < 0.5).drop(mark)
