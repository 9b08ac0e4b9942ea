"""Cross-entropy difference of two n-gram language models.

A target model (texts labelled good and not toxic) and a background model (all
texts) share one vocabulary, the bytes, and are matched: same order, same
n-grams, same smoothing. A document's score is the mean over its bytes of the
target model's loss minus the background model's, in bits; low scores are
closest to the target.

All orders are counted exactly over all texts, in a table of one row per n-gram
that grows with the corpus and stays on the executors. Texts are dealt to chunks
of bounded size; a chunk's own n-grams are aggregated first, joined to the table
by n-gram, and handed back to the chunk, which then scores its texts. Each order
is smoothed towards the one below (Dirichlet).

Defined results. Null or empty text: 0 tokens and null losses. No labels: the
target counts are empty and both models fall back on the uniform one where
nothing was seen. Repeated rows count and are scored each; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import mark_rows, materialise

ORDERS = 4
#: Orders 1 and 2 are looked up by value, one after another; higher ones by key.
SIZES = (1 << 8, 1 << 16)
OFFSETS = tuple(np.cumsum((0, *SIZES)).tolist())
#: Bytes of text in a chunk, beside one text; ROW_BYTES are added for each row.
CHUNK, ROW_BYTES = 4 << 20, 64
#: Strength of the lower order in each order's estimate.
PRIOR = 8.0
BLOCK = 1 << 19  # bytes handled at once
#: Bytes before the first real one: the longest n-gram that ends just before it.
PAD = ORDERS


@dataclass
class Model:
    """Exact counts of both models: ``counts[0]`` target, ``counts[1]`` background.

    Columns are orders 1 and 2 by value, then the n-grams of ``keys`` (sorted,
    order << 32 | n-gram). ``total`` is the number of bytes each model was trained on.
    """

    counts: np.ndarray
    keys: np.ndarray
    total: np.ndarray

    def __getitem__(self, m: int) -> np.ndarray:
        return self.counts[m]

    @classmethod
    def of(cls, keys: np.ndarray, target: np.ndarray, background: np.ndarray, total: np.ndarray | None = None) -> Model:
        """A model of these n-grams; repeated keys have equal counts."""
        keys, first = np.unique(keys, return_index=True)
        both = np.stack([target[first], background[first]]).astype(float)
        low = np.searchsorted(keys, 3 << 32)
        counts = np.zeros((2, OFFSETS[-1] + len(keys) - low))
        gram, order = keys[:low] & 0xFFFFFFFF, keys[:low] >> 32
        counts[:, np.array(OFFSETS)[order - 1] + gram] = both[:, :low]
        counts[:, OFFSETS[-1] :] = both[:, low:]
        return cls(counts, keys[low:], counts[:, : SIZES[0]].sum(axis=1) if total is None else total)

    def look(self, n: int, grams: np.ndarray) -> np.ndarray:
        """(2, grams) counts of n-grams of order n + 1; 0 for one that is not there."""
        if n < len(SIZES):
            return self.counts[:, OFFSETS[n] + grams]
        if not len(self.keys):
            return np.zeros((2, len(grams)))
        each, back = np.unique(grams, return_inverse=True)
        key = _key(n, each)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.counts[:, OFFSETS[-1] + at] * (self.keys[at] == key))[:, back]


def _key(n: int, grams: np.ndarray) -> np.ndarray:
    return (n + 1) << 32 | grams.astype(np.int64)


def _grams(buf: np.ndarray) -> list[np.ndarray]:
    """For each order, the n-gram that ends at each byte from the last one of the
    pad on, so that every real byte has its context before it."""
    b = buf.astype(np.uint32)
    one = b[3:]
    two = (b[2:-1] << np.uint32(8)) | one
    three = (b[1:-2] << np.uint32(16)) | two
    four = (b[:-3] << np.uint32(24)) | three
    return [one, two, three, four]


def _blocks(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(padded bytes, mask of real bytes and owner by slot) of bounded size."""
    parts: list[bytes] = []
    owners: list[int] = []
    size = 0

    def done():
        buf = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.array([len(p) for p in parts])
        real = np.ones(len(buf), bool)
        for at in np.cumsum(np.append(0, lengths[:-1])):
            real[at : at + PAD] = False
        return buf, real[PAD - 1 :], np.repeat(owners, lengths)[PAD - 1 :]

    for i, raw in enumerate(raws):
        for k in range(0, len(raw), BLOCK):
            # A later piece of a long text starts with the bytes before it.
            parts.append((bytes(PAD) + raw[:BLOCK]) if k == 0 else raw[k - PAD : k + BLOCK])
            owners.append(i)
            size += len(parts[-1])
            if size >= BLOCK:
                yield done()
                parts, owners, size = [], [], 0
    if parts:
        yield done()


def _tally(raws: list[bytes], own: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, background, target): the n-grams of texts and their counts.

    The contexts of a text's first byte are among them, if only with count 0.
    """
    keys = [_key(n, np.zeros(1)) for n in range(ORDERS - 1)]
    counts = [np.zeros((2, 1))] * len(keys)
    for of_target in (False, True):
        for buf, real, _ in _blocks([t for t, o in zip(raws, own) if o == of_target]):
            for n, grams in enumerate(_grams(buf)):
                if n < len(SIZES):
                    found = np.bincount(grams[real])
                    each = np.flatnonzero(found)
                    found = found[each]
                else:
                    each, found = np.unique(grams[real], return_counts=True)
                keys.append(_key(n, each))
                counts.append(np.stack([found, found * of_target]))
        # Merged at once, so memory follows the different n-grams.
        all_keys, back = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.concatenate(counts, axis=1)
        keys, counts = [all_keys], [np.stack([np.bincount(back, c, len(all_keys)) for c in both])]
    return keys[0], counts[0][0].astype(np.int64), counts[0][1].astype(np.int64)


def chunks(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, text, chunk, own) of every row; ``own`` marks target texts.

    Rows are dealt to chunks and written once, in order. The target's ids are joined
    to row numbers, and these mark the rows (``mark_rows``), so texts stay put.
    """
    chunk_bytes = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, seen = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
            at = done + np.cumsum(size) - size
            done += int(size.sum())
            number = first + seen + np.arange(len(size))
            seen += len(size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first + at // chunk_bytes), pa.array(number)], names=["doc_id", "text", "chunk", "row"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = materialise(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, chunk long, row long"), "chunks")
    ids = target.select("doc_id").where("doc_id is not null").distinct()
    chosen = rows.select("row", "doc_id").join(ids, "doc_id", "left_semi").select("row")
    return mark_rows(rows, "row", chosen, "own").drop("row")


def count_by_chunk(texts: DataFrame) -> DataFrame:
    """(chunk, key, background, target): each chunk's n-grams; a chunk that two tasks
    read has a row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, raws, own = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if chunk is not None:
                keys, background, target = _tally(raws, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), chunk)), pa.array(keys), pa.array(background), pa.array(target)],
                    names=["chunk", "key", "background", "target"],
                )

        for batch in batches:
            for text, mine, c in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                if c != chunk:
                    yield from done()
                    chunk, raws, own = c, [], []
                if text.is_valid:
                    raws.append(text.as_py().encode())
                    own.append(mine.as_py())
        yield from done()

    rows = texts.select("text", "own", "chunk").mapInArrow(run, "chunk long, key long, background long, target long")
    return materialise(rows, "ngrams-by-chunk")


def _sums(by_chunk: DataFrame) -> DataFrame:
    return by_chunk.groupBy("key").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def count_ngrams(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(key, background, target): exact n-gram counts over all texts of ``docs``.

    ``target`` holds the distinct doc_id of the target texts; a key is
    order << 32 | n-gram.
    """
    return _sums(count_by_chunk(chunks(docs, target)))


def tables(counted: DataFrame) -> Model:
    """The whole model in the driver's memory: for small corpora only."""
    got = counted.toArrow()
    return Model.of(*[got.column(c).to_numpy() for c in ("key", "target", "background")])


def losses(model: Model | np.ndarray, raws: list[bytes]) -> np.ndarray:
    """(2, texts): the summed losses of each text, in bits, under target and background.

    A bare array holds the counts of orders 1 and 2 only.
    """
    if isinstance(model, np.ndarray):
        model = Model(model, np.zeros(0, np.int64), model[:, : SIZES[0]].sum(axis=1))
    out = np.zeros((2, len(raws)))
    for buf, real, owner in _blocks(raws):
        seen = None
        for n, grams in enumerate(_grams(buf)):
            found = model.look(n, grams)
            if seen is None:
                p = (found + PRIOR / 256) / (model.total[:, None] + PRIOR)
            else:
                p = (found + PRIOR * p) / (np.concatenate([seen[:, :1], seen[:, :-1]], axis=1) + PRIOR)
            seen = found
        for m in range(2):
            out[m] += np.bincount(owner[real], -np.log2(p[m][real]), minlength=len(raws))
    return out


def _scored(ids: pa.Array, texts: pa.Array, model: Model) -> list[pa.Array]:
    raws = [t.as_py().encode() if t.is_valid else b"" for t in texts]
    n = np.array([len(r) for r in raws], np.int64)
    target, background = losses(model, raws)
    none = n == 0
    per = np.maximum(n, 1)
    columns = [target / per, background / per, (target - background) / per]
    return [ids, pa.array(n), *[pa.array(c, pa.float64(), mask=none) for c in columns]]


_NAMES = ["doc_id", "n_tokens", "target_bits", "background_bits", "xent_diff"]


def _schema(docs: DataFrame) -> str:
    kind = dict(docs.dtypes)["doc_id"]
    return f"doc_id {kind}, n_tokens long, target_bits double, background_bits double, xent_diff double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, xent_diff of every row, by a
    model that is held in memory."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_scored(batch.column(0), batch.column(1), shared.value), names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, _schema(docs))


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Train both models on ``docs`` (target: rows whose doc_id is in ``target``)
    and score every row, each chunk by the counts of its own n-grams."""
    texts = chunks(docs, target.select("doc_id").distinct())
    by_chunk = count_by_chunk(texts)
    table = materialise(_sums(by_chunk), "ngrams")
    total = table.where((F.col("key") >= 1 << 32) & (F.col("key") < 2 << 32)).agg(F.sum("target"), F.sum("background")).first()
    total = np.array([x or 0 for x in total], float)
    # Partitioned by n-gram: a key has a row per chunk at most, or as many as read it.
    found = by_chunk.select("chunk", "key").join(table.hint("merge"), "key")

    def run(rows: pa.Table, counted: pa.Table) -> pa.Table:
        model = Model.of(*[counted.column(c).to_numpy() for c in ("key", "target", "background")], total)
        columns = [rows.column(c).combine_chunks() for c in ("doc_id", "text")]
        return pa.Table.from_arrays(_scored(*columns, model), names=_NAMES)

    pairs = texts.select("chunk", "doc_id", "text").groupBy("chunk").cogroup(found.groupBy("chunk"))
    return pairs.applyInArrow(run, _schema(docs))
