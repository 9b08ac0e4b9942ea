"""Removal of byte strings that an earlier document has, by longest previous factors.

A byte goes if a string of WINDOW bytes covers it that also starts in a document with
a smaller ``doc_id``. Every such string, called a window, is found by an anchor: the
first of those GRAM-byte strings in it that have the least hash. Equal windows have it
in the same place, and neighbouring windows mostly share it, so a text falls into
segments of up to WINDOW - GRAM + 1 windows with one anchor.

1. Anchors that two rows hold are told from a bitmap of fixed size, built from the
   distinct hashes of each part of the corpus. A second bitmap does the same for longer
   strings around those anchors: a window reaches SIDE bytes beyond its anchor on the
   left or on the right. Bitmaps only spare work: past their capacity they let more
   through, and nothing is lost.
2. The segments that remain meet by anchor. Equal ones become one, with the least
   ``doc_id`` that has it; where a later document has it, all of it goes. The windows of
   different ones are put in suffix order, and the previous and the next smaller
   document there give the longest previous factor of each: WINDOW bytes or more mean an
   earlier match. Anchors with very many segments, as at the edges of a text that a
   third of all documents quote, are split by whole windows instead.
3. The findings return to the texts as spans, and the rest of each text is kept.

Defined results. A null text is empty; a text shorter than WINDOW loses nothing. A row
without ``doc_id`` has no smaller and is smaller than none: it keeps all and takes
nothing. Rows with the same ``doc_id`` do not take from each other, and each is judged
by its own text. Strings are judged on the input, not on what is left. ``doc_id`` is an
integer. Columns of any other name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import MAX_BROADCAST_ROWS, materialise
from orrery.llm.suffixes import previous_factors
from orrery.operators.skew import join_counted

WINDOW, GRAM = 50, 24
#: Windows of a segment at most: those that one string of GRAM bytes can be in.
SPAN = WINDOW - GRAM + 1
#: Bytes beyond its anchor that every window has on one side, at least.
SIDE = (WINDOW - GRAM) // 2
#: A bitmap of shared hashes: SLICES x 4096 bytes, 32 MB, whatever the corpus.
SLICES, SLICE_BITS = 8192, 32_768
#: Distinct hashes, segments and spans gathered before they are sent on, and bytes of text
#: worked on at once, so few that their arrays stay in a core's cache.
FLUSH, FLUSH_SEGMENTS, FLUSH_SPANS, BLOCK_BYTES = 1_000_000, 150_000, 500_000, 1 << 16
#: Segments with one anchor beyond which they are split by whole windows.
HOT_SEGMENTS = 50_000
#: Segments that are put in suffix order at once, more or less.
BLOCK_SEGMENTS = 40_000
#: Fixed odd factors of the hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9], np.uint64)
Keys = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number, zeros past the end."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    out = np.empty(len(data) + 8, np.uint64)
    for k in range(8):
        part = out[k::8]
        part[:] = padded[k : k + 8 * len(part)].view("<u8")
    return out


def segments(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, windows, anchor) of the segments of texts that lie one after another."""
    none = np.zeros(0, np.int64)
    n = len(data) - WINDOW + 1
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    at = words_at(data)
    m = len(data) - GRAM + 1
    h = at[:m] * MIX[0]
    h ^= at[8 : m + 8] * MIX[1]
    h ^= h >> np.uint64(29)
    h += at[16 : m + 16] * MIX[2]
    h ^= h >> np.uint64(32)
    h *= MIX[3]
    h ^= h >> np.uint64(31)
    # The first least hash of each window, by blocks of doubled length.
    least, off, reach = h, np.zeros(m, np.uint8), 1

    def merged(least: np.ndarray, off: np.ndarray, by: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[by : by + size] < least[:size]
        return np.minimum(least[:size], least[by : by + size]), np.where(right, off[by : by + size] + np.uint8(by), off[:size])

    while 2 * reach <= SPAN:
        least, off = merged(least, off, reach, len(least) - reach)
        reach *= 2
    least, off = merged(least, off, SPAN - reach, n)
    anchor = np.arange(n) + off
    # Windows inside one text, cut where the anchor changes.
    ends = np.cumsum(lengths)
    fits = np.maximum(lengths - WINDOW + 1, 0)
    first = ends - lengths
    change = np.zeros(n + 1, np.int32)
    has = fits > 0
    np.add.at(change, first[has], 1)
    np.add.at(change, first[has] + fits[has], -1)
    inside = np.cumsum(change[:-1]) > 0
    cut = np.ones(n, bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    cut[first[has]] = True
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, n))
    mine = inside[start]
    start, size = start[mine], size[mine]
    return least[start], start, size, anchor[start]


def _mixed(at: np.ndarray, where: np.ndarray, offsets: tuple[int, ...], tag: int) -> np.ndarray:
    h = np.full(len(where), tag, np.uint64) * MIX[1]
    for k, o in enumerate(offsets):
        h ^= at[where + o] * MIX[k % 3]
        h ^= h >> np.uint64(29)
        h *= MIX[3]
    return h ^ (h >> np.uint64(32))


def sides(data: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, ...]:
    """For segments: whether they have windows that reach SIDE bytes to the left of the
    anchor, hashes of the anchor with these bytes, and the same for the right."""
    at = words_at(data)
    left, right = start <= anchor - SIDE, start + size - 1 >= anchor - SIDE
    long = GRAM + SIDE
    offsets = (*range(0, long - 8, 8), long - 8)
    safe = np.where(left, anchor - SIDE, anchor)
    return left, _mixed(at, safe, offsets, 1), right, _mixed(at, np.where(right, anchor, 0), offsets, 2)


def has_bit(flags: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = ((h >> np.uint64(51)) * np.uint64(SLICE_BITS) + h % np.uint64(SLICE_BITS)).astype(np.int64)
    return (flags[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


def anchor_keys(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of all anchors."""
    h, start, _, _ = segments(data, lengths)
    return h, start


def side_keys(anchors) -> Keys:
    """(hash, place) of the longer strings around anchors that are in a bitmap."""

    def keys(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, start, size, anchor = segments(data, lengths)
        keep = has_bit(np.frombuffer(anchors.value, np.uint8), h)
        start, size, anchor = start[keep], size[keep], anchor[keep]
        left, hl, right, hr = sides(data, start, size, anchor)
        both = np.concatenate([hl[left], hr[right]]), np.concatenate([start[left], start[right]])
        by = np.argsort(both[1], kind="stable")
        return both[0][by], both[1][by]

    return keys


def candidates(data: np.ndarray, lengths: np.ndarray, anchors, longer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, windows) of segments that another row may have, cut down to the
    windows whose longer string may be shared."""
    h, start, size, anchor = segments(data, lengths)
    keep = has_bit(np.frombuffer(anchors.value, np.uint8), h)
    h, start, size, anchor = h[keep], start[keep], size[keep], anchor[keep]
    flags = np.frombuffer(longer.value, np.uint8)
    left, hl, right, hr = sides(data, start, size, anchor)
    left &= has_bit(flags, hl)
    right &= has_bit(flags, hr)
    turn = anchor - SIDE  # the window that has SIDE bytes on both sides
    lo = np.where(left, start, np.maximum(start, turn))
    hi = np.where(right, start + size, np.minimum(start + size, turn + 1))
    keep = (left | right) & (hi > lo)
    return h[keep], lo[keep], (hi - lo)[keep]


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, byte length of each row) of slices of a batch's texts."""
    texts = [t.as_buffer() if t.is_valid else b"" for t in batch.column(column)]
    at, held, total = 0, [], 0
    for k, text in enumerate([*texts, None]):
        if text is None or (held and total + len(text) > BLOCK_BYTES):
            if held:
                sizes = np.array([len(t) for t in held])
                yield at, np.frombuffer(b"".join(held), np.uint8), sizes
            at, held, total = k, [], 0
        if text is not None:
            held.append(text)
            total += len(text)


def shared_hashes(docs: DataFrame, keys: Keys) -> bytes:
    """The bitmap of ``keys`` that two rows hold, or more: SLICES x SLICE_BITS bits.

    It has the same size whatever the corpus. Each part of the corpus sends its
    distinct hashes once, six bytes each, so a frequent one is not sent per document.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        count = row = 0

        def flush() -> pa.RecordBatch:
            h, d = np.concatenate(held), np.concatenate(rows)
            by = np.argsort(h, kind="stable")
            h, d = h[by], d[by]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            leader = np.flatnonzero(new)
            several = np.maximum.reduceat(d, leader) != d[leader]
            sent = np.repeat(h[leader], 1 + several)  # twice where two rows here hold it
            top = (sent >> np.uint64(51)).astype(np.int64)
            low = sent.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            edges = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
            bounds = np.append(edges, len(sent)).tolist()
            blobs = [low[6 * a : 6 * b] for a, b in zip(bounds, bounds[1:])]
            return pa.RecordBatch.from_arrays([pa.array(top[edges], pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "hashes"])

        for batch in batches:
            for _, data, sizes in _blocks(batch, 0):
                h, start = keys(data, sizes)
                if len(h):
                    held.append(h)
                    rows.append(row + np.searchsorted(np.cumsum(sizes), start, side="right"))
                    count += len(h)
                row += len(sizes)
                if count >= FLUSH:
                    yield flush()
                    held, rows, count = [], [], 0
        if count:
            yield flush()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits(at: int, blobs: list[bytes]) -> pa.RecordBatch:
            low = np.zeros((sum(map(len, blobs)) // 6, 8), np.uint8)
            low[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
            value, times = np.unique(low.view("<u8").ravel(), return_counts=True)
            flags = np.zeros(SLICE_BITS, bool)
            flags[(value[times > 1] % SLICE_BITS).astype(np.int64)] = True
            out = np.packbits(flags, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([out], pa.binary())], names=["slice", "bits"])

        at, blobs = -1, []
        for batch in batches:
            for here, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if here != at and blobs:
                    yield bits(at, blobs)
                    blobs = []
                at = here
                blobs.append(blob)
        if blobs:
            yield bits(at, blobs)

    sent = docs.where("doc_id is not null").select("text").mapInArrow(distinct, "slice int, hashes binary")
    placed = sent.repartition("slice").sortWithinPartitions("slice")
    found = placed.mapInArrow(repeated, "slice int, bits binary")
    whole = bytearray(SLICES * SLICE_BITS // 8)
    for row in found.collect():  # SLICES rows of 4096 bytes at most
        whole[row["slice"] * SLICE_BITS // 8 : (row["slice"] + 1) * SLICE_BITS // 8] = row["bits"]
    return bytes(whole)


SPANS = "array<struct<from: long, to: long>>"


def occurrences(docs: DataFrame, anchors, longer) -> DataFrame:
    """Every candidate segment: hash, id (of its bytes), doc_id, text_id, start, length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, data, sizes in _blocks(batch, 2):
                h, start, size = candidates(data, sizes, anchors, longer)
                owner = row + np.searchsorted(np.cumsum(sizes), start, side="right")
                begin = start - (np.cumsum(sizes) - sizes)[owner - row]
                raw, length = data.tobytes(), size + WINDOW - 1
                named = [segment_id(raw[a : a + b]) for a, b in zip(start.tolist(), length.tolist())]
                out = [h.view(np.int64), np.array(named, np.uint64).view(np.int64), ids[owner], texts[owner], begin, length]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["hash", "id", "doc_id", "text_id", "start", "length"])

    return _texts(docs).mapInArrow(run, "hash long, id long, doc_id long, text_id long, start long, length long")


def segment_id(segment: bytes) -> int:
    """As Spark's ``xxhash64``, unsigned."""
    return xxhash.xxh64_intdigest(segment, 42)


def packed(docs: DataFrame, anchors, longer, hot, slices: int) -> DataFrame:
    """slice and blob: candidate segments whose anchor is not ``hot`` (sorted hashes), packed
    by the slice of their hash; equal ones among neighbouring texts only once, with the
    least doc_id and how many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, list[int]] = {}
        for h, segment, doc in _each(batches, anchors, longer, hot.value, False):
            had = least.get(segment)
            if had is None:
                if len(least) >= FLUSH_SEGMENTS:
                    yield pack(least, slices)
                    least = {}
                least[segment] = [h, doc, 1]
                continue
            had[2] += 1
            if doc < had[1]:
                had[1] = doc
        if least:
            yield pack(least, slices)

    return _texts(docs).mapInArrow(run, "slice long, blob binary")


def pack(least: dict[bytes, list[int]], slices: int) -> pa.RecordBatch:
    """Rows of slice and blob, from the hash, the document and the count of each segment:
    hashes, documents, counts, lengths and bytes, compressed."""
    keys, numbers = list(least), np.array(list(least.values()), np.int64)
    at = numbers[:, 0] % slices
    by = np.lexsort((numbers[:, 0], at))
    numbers, at, blobs = numbers[by], at[by], [keys[k] for k in by.tolist()]
    h = numbers[:, 0]
    sizes = np.array([len(x) for x in blobs], np.int64)
    edges = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    out = []
    for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(h)]):
        head = np.concatenate([[hi - lo], h[lo:hi], numbers[lo:hi, 1], numbers[lo:hi, 2], sizes[lo:hi]])
        out.append(zlib.compress(head.tobytes() + b"".join(blobs[lo:hi]), 1))
    return pa.RecordBatch.from_arrays([pa.array(at[edges]), pa.array(out, pa.binary())], names=["slice", "blob"])


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    raw = zlib.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    h, doc, count, sizes = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
    ends = (8 + 32 * n + np.cumsum(sizes)).tolist()
    return h, doc, count, [raw[e - s : e] for e, s in zip(ends, sizes.tolist())]


def with_bytes(docs: DataFrame, anchors, longer, hot) -> DataFrame:
    """hash, id, doc_id and segment (its bytes) of candidate segments with a ``hot`` anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int]] = []

        def batch() -> pa.RecordBatch:
            h, segment, doc = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()), pa.array(segment, pa.binary())], names=["hash", "doc_id", "segment"])

        for one in _each(batches, anchors, longer, hot.value, True):
            held.append(one)
            if len(held) >= FLUSH_SEGMENTS:
                yield batch()
                held.clear()
        if held:
            yield batch()

    found = _texts(docs).mapInArrow(run, "hash long, doc_id long, segment binary")
    return found.select("hash", F.xxhash64("segment").alias("id"), "doc_id", "segment")


def _each(batches: Iterator[pa.RecordBatch], anchors, longer, hot: np.ndarray, only_hot: bool) -> Iterator[tuple[int, bytes, int]]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for row, data, sizes in _blocks(batch, 2):
            h, start, size = candidates(data, sizes, anchors, longer)
            keep = np.isin(h.view(np.int64), hot) == only_hot
            h, start, size = h[keep], start[keep], size[keep]
            owner = ids[row + np.searchsorted(np.cumsum(sizes), start, side="right")]
            raw = data.tobytes()
            found = [raw[a:b] for a, b in zip(start.tolist(), (start + size + WINDOW - 1).tolist())]
            yield from zip(h.view(np.int64).tolist(), found, owner.tolist())


def _texts(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id is not null and text is not null")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")


def factor_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of packed segments (slice, blob) in the order of slices: hash, id, the first
    document, how many rows have it, and the spans (from, to) whose windows a document
    before the first has in another segment. Slices are worked on together until they
    hold BLOCK_SEGMENTS."""
    held: list[tuple] = []
    at, count = None, 0
    for batch in batches:
        for here, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if here != at and count >= BLOCK_SEGMENTS:
                yield _factor_block(held)
                held, count = [], 0
            at = here
            held.append(unpack(blob.as_buffer().to_pybytes()))
            count += len(held[-1][0])
    if held:
        yield _factor_block(held)


def _factor_block(held: list[tuple]) -> pa.RecordBatch:
    hashes, docs, n = (np.concatenate([part[k] for part in held]) for k in range(3))
    blobs = [x for part in held for x in part[3]]
    by = sorted(range(len(blobs)), key=lambda k: blobs[k])
    by = np.array(by)[np.argsort(hashes[by], kind="stable")]
    hashes, docs, n, blobs = hashes[by], docs[by], n[by], [blobs[k] for k in by.tolist()]
    new = np.fromiter((k == 0 or x != blobs[k - 1] for k, x in enumerate(blobs)), bool, len(blobs))
    head = np.flatnonzero(new)
    first, rows = np.minimum.reduceat(docs, head), np.add.reduceat(n, head)
    blobs = [blobs[k] for k in head.tolist()]
    # A segment that is alone with its anchor has no other to match.
    anchor = hashes[head]
    alone = np.ones(len(head), bool)
    alone[1:] &= anchor[1:] != anchor[:-1]
    alone[:-1] &= anchor[1:] != anchor[:-1]
    length = np.array([len(b) for b in blobs])
    windows = np.where(alone, 0, length - WINDOW + 1)
    of = np.repeat(np.arange(len(blobs)), windows)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (np.cumsum(length) - length)[of] + nth
    order, lcp = window_order(np.frombuffer(b"".join(blobs), np.uint8), at)
    factor = np.empty(len(at), np.int64)
    factor[order] = previous_factors(first[of[order]], lcp)
    earlier = factor >= WINDOW
    # Neighbouring windows of one segment become one span.
    edge, stop = earlier.copy(), earlier.copy()
    edge[1:] &= ~(earlier[:-1] & (of[1:] == of[:-1]))
    stop[:-1] &= ~(earlier[1:] & (of[1:] == of[:-1]))
    a, b = np.flatnonzero(edge), np.flatnonzero(stop)
    held_by = np.bincount(of[a], minlength=len(blobs))
    keep = np.flatnonzero((rows > 1) | (held_by > 0))
    bounds = np.concatenate([[0], np.cumsum(held_by[keep])])
    spans = pa.StructArray.from_arrays([pa.array(nth[a]), pa.array(nth[b] + WINDOW)], names=["from", "to"])
    ids = np.array([segment_id(blobs[k]) for k in keep.tolist()], np.uint64).view(np.int64)
    out = [pa.array(x) for x in (anchor[keep], ids, first[keep], rows[keep])]
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)
    return pa.RecordBatch.from_arrays([*out, lists], names=["hash", "id", "first", "n", "spans"])


def by_window(rows: DataFrame) -> DataFrame:
    """What ``factor_spans`` gives, for anchors with very many segments: every window is
    joined to the first document that has it."""
    own = rows.groupBy("hash", "id").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.min("segment").alias("segment"))
    own = materialise(own, "hot-segments")
    nth = F.sequence(F.lit(0), F.octet_length("segment") - WINDOW)
    each = own.select("hash", "id", "first", "segment", F.explode(nth).alias("nth"))
    each = each.select("hash", "id", "first", "nth", F.substring(F.col("segment"), F.col("nth") + 1, F.lit(WINDOW)).alias("window"))
    least = materialise(each.groupBy("window").agg(F.min("first").alias("least"), F.count("*").alias("n")), "windows")
    late = join_counted(each, least, "window", "n").where("least < first")
    span = F.struct(F.col("nth").cast("long").alias("from"), (F.col("nth") + WINDOW).cast("long").alias("to"))
    found = late.groupBy("hash", "id").agg(F.collect_list(span).alias("spans"))
    return own.drop("segment").join(found, ["hash", "id"], "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def earlier_spans(docs: DataFrame, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, text_id, spans): the maximal spans of bytes, of each text that has any, that
    an earlier document has. ``text_id`` is the xxhash64 of the text."""
    spread = docs.sparkSession.sparkContext.broadcast
    anchors = spread(shared_hashes(docs, anchor_keys))
    longer = spread(shared_hashes(docs, side_keys(anchors)))
    rows = materialise(occurrences(docs, anchors, longer), "occurrences")
    # Fewer than MAX_BROADCAST_ROWS anchors hold more than this.
    total = rows.count()
    limit = max(hot_segments, total // MAX_BROADCAST_ROWS)
    many = rows.groupBy("hash").agg(F.count("*").alias("of")).where(F.col("of") > limit)
    listed = np.sort(np.array([r["hash"] for r in many.select("hash").collect()], np.int64))
    hot = spread(listed)
    placed = packed(docs, anchors, longer, hot, max(SLICES, total // BLOCK_SEGMENTS)).repartition("slice").sortWithinPartitions("slice")
    findings = placed.mapInArrow(factor_spans, f"hash long, id long, first long, n long, spans {SPANS}")
    if len(listed):
        findings = findings.unionByName(by_window(with_bytes(docs, anchors, longer, hot)))
    # All of a segment goes in documents after its first; in the first, what was found.
    known = materialise(findings, "findings")
    span = lambda a, b: F.struct(a.cast("long").alias("from"), b.cast("long").alias("to"))
    start = F.col("start")
    whole = F.array(span(start, start + F.col("length")))
    own = F.transform("spans", lambda x: span(start + x["from"], start + x["to"]))
    joined = join_counted(rows, known, ["hash", "id"], "n")
    gone = F.inline(F.when(F.col("doc_id") > F.col("first"), whole).otherwise(own))
    # Repeated rows become one and neighbouring segments one span before anything is sent.
    near = joined.select("doc_id", "text_id", gone).mapInArrow(_united, SPAN_ROWS)
    placed = near.repartition("doc_id", "text_id").sortWithinPartitions("doc_id", "text_id")
    return placed.mapInArrow(_listed, f"doc_id long, text_id long, spans {SPANS}")


SPAN_ROWS = "doc_id long, text_id long, from long, to long"


def unite(rows: np.ndarray) -> np.ndarray:
    """Rows doc_id, text_id, from, to in order, where spans that overlap or meet are one."""
    doc, text, a, b = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    if not len(doc):
        return rows
    group = np.cumsum(np.append(0, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])))
    # Each text is moved past the end of the one before, so that one running maximum does.
    far = group * (b.max() + 1)
    reach = np.maximum.accumulate(b + far)
    head = np.flatnonzero(np.append(True, (a + far)[1:] > reach[:-1]))
    stop = reach[np.append(head[1:], len(a)) - 1] - far[head]
    return np.stack([doc[head], text[head], a[head], stop])


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([column.to_numpy() for column in batch.columns])


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans united as far as FLUSH_SPANS of them lie together."""
    held: list[np.ndarray] = []
    count = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in unite(np.concatenate(held, axis=1))], names=["doc_id", "text_id", "from", "to"])

    for batch in batches:
        held.append(_numbers(batch))
        count += len(batch)
        if count >= FLUSH_SPANS:
            yield flush()
            held, count = [], 0
    if count:
        yield flush()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of texts: the spans of each text as one list. What is held
    from batch to batch are the united spans of one text."""

    def lists(rows: np.ndarray) -> pa.RecordBatch:
        doc, text, a, b = rows
        head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])))
        spans = pa.StructArray.from_arrays([pa.array(a), pa.array(b)], names=["from", "to"])
        each = pa.ListArray.from_arrays(pa.array(np.append(head, len(doc)), pa.int32()), spans)
        return pa.RecordBatch.from_arrays([pa.array(doc[head]), pa.array(text[head]), each], names=["doc_id", "text_id", "spans"])

    held = np.zeros((4, 0), np.int64)
    for batch in batches:
        held = unite(np.concatenate([held, _numbers(batch)], axis=1))
        last = (held[0] == held[0, -1]) & (held[1] == held[1, -1]) if held.size else np.zeros(0, bool)
        if not last.all():
            yield lists(held[:, ~last])
            held = held[:, last]
    if held.size:
        yield lists(held)


def window_order(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``at``, each cut after WINDOW bytes, in order, and how many bytes
    each shares with the one before."""
    words = words_at(np.concatenate([data, np.zeros(WINDOW, np.uint8)])).byteswap()
    cut = np.uint64(64 - 8 * (WINDOW % 8))

    def word(k: int, i: np.ndarray) -> np.ndarray:
        w = words[at[i] + 8 * k]
        return w if 8 * k + 8 <= WINDOW else w >> cut << cut

    n, parts = len(at), -(-WINDOW // 8)
    order = np.argsort(word(0, np.arange(n)), kind="stable")
    lcp = np.zeros(n, np.int64)
    open_ = np.arange(1, n)  # places that share all words so far with the place before
    for k in range(parts):
        if k and len(open_):
            # Groups of places that still tie are put in order by their next word.
            member = np.zeros(n, bool)
            member[open_] = member[open_ - 1] = True
            place = np.flatnonzero(member)
            tied = np.zeros(n, bool)
            tied[open_] = True
            group = np.cumsum(~tied[place])
            rows = order[place]
            order[place] = rows[np.lexsort((word(k, rows), group))]
        w = word(k, order[open_]) ^ word(k, order[open_ - 1])
        differ = w != 0
        high = np.zeros(len(w), np.int64)
        for byte in range(8):
            high += (w >> np.uint64(56 - 8 * byte)) == 0
        lcp[open_] = np.minimum(WINDOW, 8 * k + np.where(differ, high, 8))
        open_ = open_[~differ]
    return order, lcp


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, kept = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            gone = [(x["from"], x["to"]) for x in spans.as_py() or []]
            at, parts = 0, []
            for lo, hi in gone:
                parts.append(data[at:lo])
                at = hi
            parts.append(data[at:])
            sizes.append(len(data))
            kept.append(b"".join(parts))
            removed.append([{"start": lo, "length": hi - lo} for lo, hi in gone])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        out = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_bytes", "removed", "kept"])


def remove_later_copies(docs: DataFrame, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, removed (maximal spans of start and length, in bytes) and kept
    (the other bytes, one after another) for every row of ``docs``.

    The spans are broadcast to the texts up to MAX_BROADCAST_ROWS documents that have
    any; beyond, texts and spans meet by a shuffle.
    """
    kind = dict(docs.dtypes)["doc_id"]
    spans = materialise(earlier_spans(docs, hot_segments).withColumnsRenamed({"doc_id": "_doc", "text_id": "_text"}), "spans")
    if spans.count() <= MAX_BROADCAST_ROWS:
        spans = F.broadcast(spans)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
    both = texts.join(spans, (texts["doc_id"].cast("long") == spans["_doc"]) & (texts["text_id"] == spans["_text"]), "left")
    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start: long, length: long>>, kept binary"
    return both.select("doc_id", "text", "spans").mapInArrow(_keep, schema)


def digest(done: DataFrame) -> DataFrame:
    """Counts and a digest of each row of ``remove_later_copies``."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["length"])
    return done.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
