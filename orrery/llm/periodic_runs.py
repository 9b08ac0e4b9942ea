"""Periodic runs of words: stretches that repeat a shorter stretch back to back.

The branching-tandem test over an enhanced suffix array. A block of texts gets one
suffix array of words. Each interval of equal common prefix is known by its borders
in the array of common prefixes; no tree is built. Of an interval's children all but
the largest are walked: a suffix i of an interval of depth D is checked by looking up
whether i + D or i - D lies in the same interval. A hit whose next words differ is a
branching square of period D. Rotating it to the left as far as the words agree gives
the run that it ends; squares of one run, of its period or a multiple, have the same
borders and are merged under the least period.

Defined results. A null, empty or blank text has no word and no run. Rows are judged
one by one, so ids may be null, tie or repeat. Columns of any other name are ignored.
An empty table gives an empty result. A text is read whole, in one task, whatever its
length; memory grows with the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.suffixes import SuffixArray, next_smaller, previous_smaller

#: Least length of a run in words; a run is also at least twice its period.
MIN_LENGTH = 12
#: Bytes of text in a block, which has one suffix array; a longer text is a block.
BLOCK_BYTES = 6 << 20

Order = Callable[[int | None, int], np.ndarray | None]


def branching_squares(sa: SuffixArray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares whose next word does not repeat."""
    n = len(symbols)
    lcp = sa.lcp()
    at = np.flatnonzero(lcp)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none
    low, high = previous_smaller(lcp, at), next_smaller(lcp, at)
    # Borders of one interval share its left end and its depth; they are in order.
    by = np.lexsort((at, lcp[at], low))
    at, low, high = at[by], low[by], high[by]
    depth = lcp[at]
    head = np.ones(len(at), bool)
    head[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    group = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    # Children: one before the first border of an interval, and one from each border.
    to = np.empty_like(at)
    to[:-1] = at[1:]
    last = np.append(heads[1:], len(at)) - 1
    to[last] = high[last]
    start = np.concatenate([low[heads], at])
    size = np.concatenate([at[heads] - low[heads], to - at])
    of = np.concatenate([np.arange(len(heads)), group])
    by = np.lexsort((-size, of))
    start, size, of = start[by], size[by], of[by]
    small = np.zeros(len(of), bool)
    small[1:] = of[1:] == of[:-1]  # all but the largest of each interval
    start, size, of = start[small], size[small], of[small]
    # The suffixes of the smaller children.
    steps = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    i = sa.order[np.repeat(start, size) + steps].astype(np.int64)
    own = heads[np.repeat(of, size)]
    d, lo, hi = depth[own], low[own], high[own]
    padded = np.append(symbols, -1)
    found = []
    for first in (i, i - d):
        other = first + d if first is i else first
        ok = (other >= 0) & (other < n)
        where = sa.place[np.where(ok, other, 0)]
        ok &= (where >= lo) & (where < hi)
        a, p = first[ok], d[ok]
        ends = padded[np.minimum(a + p, n)] != padded[np.minimum(a + 2 * p, n)]
        found.append(np.stack([a[ends], p[ends]]))
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def runs_of(symbols: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of every run of a block, by start and period."""
    sa = SuffixArray(symbols, ends)
    start, period = branching_squares(sa, symbols)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    back = sa.common_before(start, start + period)
    begin, stop = start - back, start + 2 * period
    long = stop - begin >= min_length
    begin, stop, period = begin[long], stop[long], period[long]
    by = np.lexsort((period, stop, begin))
    begin, stop, period = begin[by], stop[by], period[by]
    new = np.ones(len(by), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (stop[1:] != stop[:-1])
    out = np.stack([begin[new], stop[new] - begin[new], period[new]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(flat), 0)
    count = np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return flat.filter(full), count


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about BLOCK_BYTES of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + BLOCK_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _judge(ids: pa.Array, texts: pa.Array, order: Order | None, min_length: int) -> list[pa.Array]:
    words, count = _words(texts)
    offsets = np.concatenate([[0], np.cumsum(count)])
    if order is not None:
        take, moved = np.arange(len(words)), False
        for k, doc in enumerate(ids.to_pylist()):
            new = order(doc, int(count[k])) if count[k] else None
            if new is not None:
                take[offsets[k] : offsets[k + 1]] = offsets[k] + new
                moved = True
        words = words.take(pa.array(take)) if moved else words
    owner = np.repeat(np.arange(len(ids)), count)
    runs, dropped = np.zeros((0, 3), np.int64), np.zeros(len(words), bool)
    if len(words):
        coded = words.dictionary_encode()
        symbols = owner * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
        runs = runs_of(symbols, offsets[1:][owner], min_length)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        dropped = np.cumsum(change[:-1]) > 0
    of = owner[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    fields = [pa.array(runs[:, 0] - offsets[of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    pieces = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(ids)))])
    kept = np.concatenate([[0], np.cumsum(np.bincount(owner[~dropped], minlength=len(ids)))])
    left = words if not dropped.any() else words.filter(pa.array(~dropped))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), left), " ")
    return [ids, pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces), joined]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, order: Order | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words) and the collapsed
    text, which keeps of each run its first period, for every row of ``docs``.

    ``order(doc_id, n)`` may give the word numbers in which a text of n words is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                out = _judge(part.column(0), part.column(1), order, min_length)
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    span = "array<struct<start: long, length: long, period: long>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs {span}, collapsed string")


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order that makes one text in ten end in a run: from word a on, p words repeat."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def digest(found: DataFrame) -> DataFrame:
    """The longest run of each row of ``find_runs`` and digests of its runs and text."""

    def longest() -> Column:
        ranked = F.transform("runs", lambda x: F.struct((-x["length"]).alias("short"), x["start"].alias("start"), x["period"].alias("period")))
        return F.array_min(ranked)

    line = lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))
    best = found.withColumn("_best", longest())
    length, period = -F.col("_best.short"), F.col("_best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        ((length * 1000 - length * 1000 % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
