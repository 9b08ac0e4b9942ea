"""Quality by importance resampling with hashed n-gram generative models.

Two bag-of-n-grams models over the same hashed buckets are estimated: one from
target texts (labelled good), one from all raw texts. A document's importance is
the log ratio of its probability under the two. A sample is drawn without
replacement by Gumbel top-k: each document's log importance gets its own Gumbel
noise, and the k largest stay.

The n-grams are of words and, in buckets of their own, of word shapes: runs of
upper-case letters, of other letters and of digits are each one symbol, repeated
signs one, other characters stand for themselves, and a word equal to the one
before is marked. Words speak of vocabulary; shapes, which rare words share, of
form in any script (shouting, symbol noise, tables, stammering).

The size of the sample is the number of documents whose importance reaches the
cut that best separates labelled good from labelled bad documents; without
labels every document stays. The raw model counts all texts; target texts and
the cut come from a bounded sample of labels.

Defined results. Null or blank text: no n-grams, log importance 0. Documents
that tie with the k-th key all stay. A null id draws the noise of id null.
Rows of one id draw the same noise, and each is judged by its own text; so repeated
rows stay or go together. Extra columns, of any name, are ignored by ``resample``
and kept by ``keep_selected``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import fresh, materialise, sample_order

#: Buckets of word n-grams, and as many of shape n-grams after them.
HALF = 1 << 13
BUCKETS = 2 * HALF
#: Labelled documents per class at most, for the target model and for the cut.
SAMPLE_PER_CLASS = 5000
SEED = 11
MEMO_WORDS = 50_000
#: Characters of text whose n-grams are hashed at once.
BLOCK_CHARS = 1 << 19
#: A k-th key is searched in histograms of so many bins.
BINS = 1024

_RUNS = [
    (regex.compile(p), s)
    for p, s in ((r"[\p{Lu}\p{Lt}]+", "A"), (r"[^\P{L}A]+", "a"), (r"\p{N}+", "0"), (r"(.)\1+", r"\1"))
]


def shape(word: str) -> str:
    """The form of a word; scripts without case count as lower case.

    Lower-case words, the bulk, are told without a pattern.
    """
    if word.islower() and word.isalpha():
        return "a"
    for pattern, symbol in _RUNS:
        word = pattern.sub(symbol, word)
    return word


class _Words(dict):
    """word -> (hash << 32) + hash of its shape; bounded, in two generations, so
    that frequent words stay when the memo turns over."""

    older: dict[bytes, int] = {}

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.older = dict(self)
            self.clear()
        code = self.older.get(raw)
        if code is None:
            form = zlib.crc32(shape(raw.decode(errors="replace")).encode())
            code = (zlib.crc32(raw) << 32) + form
        self[raw] = code
        return code


_words = _Words()


def _hashed(t: np.ndarray) -> list[np.ndarray]:
    """Buckets below HALF of the unigrams and bigrams of a sequence."""
    mix, top = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - HALF.bit_length() + 1)
    one = (t + np.uint64(1)) * mix >> top
    two = (t[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + t[1:] + np.uint64(7)) * mix >> top
    return [one, two]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner): hashed unigrams and bigrams of the words and shapes of texts,
    and which of the texts each is from."""
    raws = [t.encode().split() if t else [] for t in texts]
    lengths = [len(r) for r in raws]
    code = np.fromiter(map(_words.__getitem__, chain.from_iterable(raws)), np.uint64, sum(lengths))
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[1:] == owner[:-1]
    word = code >> np.uint64(32)
    again = np.zeros(len(code), np.uint64)
    again[1:] = inside & (word[1:] == word[:-1])
    form = (code & np.uint64(0xFFFFFFFF)) * np.uint64(2) + again
    buckets, follows = [], owner[1:][inside]
    for base, sequence in ((0, word), (HALF, form)):
        one, two = _hashed(sequence)
        buckets += [one + np.uint64(base), two[inside] + np.uint64(base)]
    return np.concatenate(buckets).astype(np.int64), np.concatenate([owner, follows, owner, follows])


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of a column, in blocks of bounded size or one text."""
    first, texts, size = 0, [], 0
    for k, text in enumerate(column):
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= BLOCK_CHARS:
            yield first, texts
            first, texts, size = k + 1, [], 0
    if texts:
        yield first, texts


def _labelled(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, good): a bounded sample of each class; contradictions count as bad."""
    y = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("good"))
    part = [y.where(F.col("good") == k).orderBy(sample_order("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return materialise(part[0].unionByName(part[1]), "quality-sample")


def counts(docs: DataFrame, labelled: DataFrame) -> np.ndarray:
    """(2, BUCKETS): n-gram counts of the raw texts and of the target texts."""
    marked = docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id", "left").select("text", "good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            good = np.array([g == 1 for g in batch.column(1).to_pylist()], bool)
            for first, texts in _blocks(batch.column(0)):
                grams, owner = ngrams(texts)
                total[0] += np.bincount(grams, minlength=BUCKETS)
                total[1] += np.bincount(grams[good[first + owner]], minlength=BUCKETS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["b", "raw", "target"])

    summed = marked.mapInArrow(run, "b long, raw long, target long").groupBy("b").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    out = np.zeros((2, BUCKETS))
    for r in summed.collect():  # BUCKETS rows at most
        out[:, r["b"]] = r["raw"], r["target"]
    return out


def log_ratio(table: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each bucket, add-one smoothed, for words and shapes."""
    if not table[1].any():
        return np.zeros(BUCKETS)
    out = []
    for raw, target in zip(np.split(table[0], 2), np.split(table[1], 2)):
        # The target sample is thinner: both are smoothed by the raw model's shares.
        p = (raw + 1) / (raw + 1).sum()
        out.append(np.log((target + p * HALF) / (target.sum() + HALF) / p))
    return np.concatenate(out)


def _weighed(docs: DataFrame, ratio: np.ndarray, n_grams: str, weight: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, its number of n-grams and log importance."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    given = docs.select(*keep, *[c for c in ("text",) if c not in keep])
    at = given.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, w = np.zeros(len(batch.column(at)), np.int64), np.zeros(len(batch.column(at)))
            for first, texts in _blocks(batch.column(at)):
                grams, owner = ngrams(texts)
                rows = slice(first, first + len(texts))
                n[rows] = np.bincount(owner, minlength=len(texts))
                # Summed in the order of each text's own n-grams, so copies weigh the same.
                w[rows] = np.bincount(owner, shared.value[grams], minlength=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n), pa.array(w)], names=[*keep, n_grams, weight])

    more = [T.StructField(n_grams, T.LongType()), T.StructField(weight, T.DoubleType())]
    return given.mapInArrow(run, T.StructType([*[given.schema[c] for c in keep], *more]))


def importance(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight of every row."""
    return _weighed(docs, ratio, "n_grams", "log_weight", ["doc_id"])


def best_cut(weight: np.ndarray, good: np.ndarray) -> float | None:
    """The weight at or above which a document is called good, by balanced accuracy.

    Of the gap between the two neighbours of the cut, a tenth next to the bad side is
    taken, so that good documents just below the labelled ones still pass.
    """
    if not good.any() or good.all():
        return None
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order].astype(float)
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(1 - g)]) / (1 - g).sum()
    edge = np.concatenate([[True], w[1:] > w[:-1], [True]])
    k = int(np.argmax(np.where(edge, caught - lost, -np.inf)))
    if k == 0:
        return None
    return float(w[k - 1] + 0.1 * ((w[k] if k < len(w) else w[k - 1] + 1) - w[k - 1])) + 1e-9


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest value of ``key``, by histograms of ever narrower ranges."""
    if k <= 0:
        return None
    span = keys.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    lo, hi, need = span["lo"], span["hi"], k
    if lo is None:
        return None
    inside = keys.select("key")
    for _ in range(12):
        if lo >= hi:
            return hi
        b = F.least(F.lit(BINS - 1), F.floor((F.col("key") - lo) / ((hi - lo) / BINS))).alias("b")
        rows = inside.select(b, "key").groupBy("b").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["b"]):
            if r["n"] >= need:
                break
            need -= r["n"]
        else:
            return lo
        if need == 1:
            return r["hi"]
        if need == r["n"]:
            return r["lo"]
        lo, hi = r["lo"], r["hi"]
        inside = inside.where(F.col("key").between(lo, hi))
    return lo


def _sampled(
    docs: DataFrame, labels: DataFrame, per_class: int, k: int | None, seed: int, keep: list[str], names: list[str]
) -> tuple[DataFrame, float | None]:
    """The columns ``keep`` and, under ``names``, number of n-grams, log importance and
    Gumbel key of every row, written; and the key from which rows are in the sample.

    The texts are read twice, to count and to weigh; the sample is then a filter.
    """
    labelled = _labelled(labels, per_class)
    ratio = log_ratio(counts(docs, labelled))
    n_grams, weight, key = names
    # 53 bits of a hash make a uniform number inside (0, 1).
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11).cast("double") + 0.5) / float(2**53)
    scored = _weighed(docs, ratio, n_grams, weight, keep).withColumn(key, F.col(weight) - F.log(-F.log(u)))
    scored = materialise(scored, "importance")
    if k is None:
        bound = 4 * per_class  # rows of the labelled ids, where ids repeat
        pairs = scored.select("doc_id", F.col(weight).alias("w")).join(F.broadcast(labelled), "doc_id")
        pairs = pairs.orderBy(sample_order("doc_id"), "doc_id", "w").limit(bound).select("w", "good").collect()
        cut = best_cut(np.array([r[0] for r in pairs]), np.array([r[1] == 1 for r in pairs], bool))
        k = scored.where(F.lit(True) if cut is None else F.col(weight) >= cut).count()
    return scored, kth_largest(scored.select(F.col(key).alias("key")), k)


def resample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, k: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key, kept for every row of ``docs``.

    ``k`` fixes the size of the sample; by default it follows from the labels.
    """
    names = ["n_grams", "log_weight", "gumbel_key"]
    scored, edge = _sampled(docs, labels, per_class, k, seed, ["doc_id"], names)
    kept = F.lit(False) if edge is None else F.col("gumbel_key") >= edge
    return scored.select("doc_id", *names, kept.alias("kept"))


def keep_selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the sample leaves out, decided where the text is
    read, so no join returns to it."""
    names = [fresh(n, docs.columns) for n in ("_n_grams", "_weight", "_key")]
    scored, edge = _sampled(docs, labels, SAMPLE_PER_CLASS, None, SEED, docs.columns, names)
    kept = scored.where(F.lit(False) if edge is None else F.col(names[-1]) >= edge)
    return kept.select(*docs.columns)
