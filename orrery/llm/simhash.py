"""SimHash fingerprints and exact near-duplicate components in Hamming space.

Fingerprints of 64 bits are linked when they differ in at most ``DISTANCE``
bits. Candidates come from the generalised pigeonhole principle: the bits are
grouped into partitions, partition i gets a threshold t_i, and if the
thresholds satisfy sum(t_i + 1) = DISTANCE + 1 then two linked fingerprints
agree to within t_i bits on at least one partition i. Correlated bits go to the
same partition. The thresholds (and the number of partitions) come from dynamic
programming over candidate counts that are estimated from a bounded sample of
fingerprints, scaled to the number of fingerprints there are. Probes enumerate
the values within t_i of a fingerprint's own, and every candidate is verified.

Exact copies share one fingerprint and are one vertex. Where many different
fingerprints crowd one bucket, the bucket gets a pivot: members within the
distance of the pivot are linked to it, and a pair of such members needs no
comparison as it is connected already. So a bucket of near copies costs as many
rows as it has members, not pairs, and no link between components is lost. What
is left of such a bucket is compared by the same principle once more: of the bits
outside its partition, cut into DISTANCE + 1 blocks, two linked fingerprints agree
on one block at least, so only members of equal blocks meet.

A fingerprint or component that holds many rows meets its id by a broadcast of
the hot ones (``join_counted``), so no task gathers them.

Defined results. Null or blank text: fingerprint zero, linked like any other.
Repeated rows are returned each. A null ``doc_id`` never names a component
unless the whole component has none. Extra columns are ignored. Empty table:
empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import filter_rows, materialise, numbered, sample_order
from orrery.llm.components import connected
from orrery.operators.skew import join_counted

BITS = 64
DISTANCE = 4
SHINGLE = 4
SEED = 42
#: Fingerprints that plan the index; a documented bound, every fingerprint is indexed.
PLAN_SAMPLE = 2000
#: Different fingerprints in one bucket above which it gets pivots.
CROWDED = 256
PIVOT_ROUNDS = 4


def fingerprint(raw: bytes) -> int:
    """The fingerprint of one UTF-8 text."""
    words = raw.lower().split()  # bytes.lower touches A-Z only; split() cuts at 9-13 and 32
    if not words:
        return 0
    ones, total = np.zeros(BITS, np.int64), 0
    last = max(1, len(words) - SHINGLE + 1)
    for at in range(0, last, 4096):  # a bounded block of a long text at a time
        digest, join = xxhash.xxh64_intdigest, b" ".join
        h = np.array(
            [digest(join(words[i : i + SHINGLE]), SEED) for i in range(at, min(last, at + 4096))], dtype="<u8"
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array(
                [fingerprint(t.as_py().encode()) if t.is_valid else 0 for t in batch.column(1)], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


# --- planning -----------------------------------------------------------------


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """Split the bits into ``m`` even partitions, correlated bits together.

    ``bits`` is a 0/1 matrix of sampled fingerprints. Each partition starts at
    the free bit with the strongest ties and takes the bits tied closest to it.
    """
    with np.errstate(invalid="ignore", divide="ignore"):
        tie = np.abs(np.nan_to_num(np.corrcoef(bits.T))) if len(bits) > 2 else np.zeros((BITS, BITS))
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        first = max(sorted(free), key=lambda b: tie[b, sorted(free)].sum())
        part = [first]
        free.remove(first)
        while len(part) < width:
            best = max(sorted(free), key=lambda b: tie[b, part].mean())
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def allocate(cost: np.ndarray, distance: int = DISTANCE) -> tuple[float, list[int]]:
    """Thresholds of least total cost with sum(t_i + 1) = distance + 1.

    ``cost[i, e + 1]`` is the estimated cost of threshold e in partition i;
    threshold -1 leaves a partition out and costs nothing.
    """
    m, need = len(cost), distance + 1
    best = np.full((m + 1, need + 1), np.inf)
    take = np.zeros((m + 1, need + 1), int)
    best[0, 0] = 0
    for i in range(m):
        for have in range(need + 1):
            for e in range(min(cost.shape[1], need - have + 1)):
                if (c := best[i, have] + cost[i, e]) < best[i + 1, have + e]:
                    best[i + 1, have + e], take[i + 1, have + e] = c, e
    out, have = [], need
    for i in range(m, 0, -1):
        out.append(int(take[i, have]) - 1)
        have -= take[i, have]
    return float(best[m, need]), out[::-1]


def plan(sample: np.ndarray, rows: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each used partition for ``rows`` fingerprints."""
    sample, rows = sample.astype(np.uint64), max(rows, 1)  # probes always cost something
    bits = (
        np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if len(sample)
        else np.zeros((0, BITS), np.uint8)
    )
    choices = []
    for m in range(2, DISTANCE + 2):
        parts, cost = group_bits(bits, m), np.zeros((m, DISTANCE + 2))
        for i, part in enumerate(parts):
            own = bits[:, part].astype(np.float32)
            if len(own) > 1:
                apart = own @ (1 - own).T
                apart = np.rint(apart + apart.T).astype(int)[np.triu_indices(len(own), 1)]
                near = np.bincount(apart, minlength=BITS + 1) / len(apart)
            else:
                near = np.zeros(BITS + 1)
            probes, w = 0, len(part)
            for e in range(DISTANCE + 1):
                probes += math.comb(w, e)
                # No sampled pair so close: use the rate of random bits.
                rate = max(near[: e + 1].sum(), probes / 2.0**w)
                cost[i, e + 1] = 20 * rows * probes + rows * rows * rate / 2
        total, t = allocate(cost)
        choices.append((total, m, parts, t))
    _, _, parts, t = min(choices, key=lambda c: c[:2])
    return [(p, e) for p, e in zip(parts, t) if e >= 0]


# --- candidates ---------------------------------------------------------------


def _mask(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - 2**64 if value >= 2**63 else value


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _keys(nodes: DataFrame, parts: list[tuple[list[int], int]], probes: bool) -> DataFrame:
    """(part, key, fp): index keys, or all values within each part's threshold."""
    out = []
    for k, (bits, t) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        flips = [c for e in range((t if probes else 0) + 1) for c in itertools.combinations(bits, e)]
        keys = [F.struct(F.lit(k).alias("part"), own.bitwiseXOR(F.lit(_mask(c))).alias("key")) for c in flips]
        out.append(F.array(*keys))
    return nodes.select("fp", F.explode(F.concat(*out)).alias("k")).select("k.part", "k.key", "fp")


def _agreeing(u: DataFrame, v: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Pairs (u, v) near each other of two tables (part, key, u) and (part, key, v)."""
    masks = []
    for bits, _ in parts:
        rest = [b for b in range(BITS) if b not in bits]
        cuts = [k * len(rest) // (DISTANCE + 1) for k in range(DISTANCE + 2)]
        masks.append(F.array(*[F.lit(_mask(rest[a:b])) for a, b in zip(cuts, cuts[1:])]))
    own = F.get(F.array(*masks), F.col("part"))

    def blocks(df: DataFrame, fp: str) -> DataFrame:
        values = F.transform(own, lambda m: m.bitwiseAND(F.col(fp)))
        return df.select("part", "key", fp, F.posexplode(values).alias("block", "value"))

    met = blocks(u, "u").join(blocks(v, "v"), ["part", "key", "block", "value"])
    return met.where(_near("u", "v")).select("u", "v")


def links(nodes: DataFrame, parts: list[tuple[list[int], int]], crowded: int = CROWDED) -> DataFrame:
    """Edges (u, v) that connect exactly what pairs within DISTANCE connect."""
    index, probes = _keys(nodes, parts, False), _keys(nodes, parts, True)
    sizes = index.groupBy("part", "key").agg(F.count("*").alias("n"), F.min("fp").alias("pivot"))
    hot = materialise(sizes.where(F.col("n") > crowded), "crowded")
    some_hot = not hot.isEmpty()
    a, b = index.withColumnRenamed("fp", "u"), probes.withColumnRenamed("fp", "v")
    if some_hot:
        # Crowded buckets are few; they go their own way.
        marked = hot.select("part", "key")
        cold = a.join(marked, ["part", "key"], "left_anti").join(b, ["part", "key"])
    else:
        cold = a.join(b, ["part", "key"])
    edges = cold.where((F.col("u") < F.col("v")) & _near("u", "v")).select("u", "v")
    if not some_hot:
        return edges
    own = materialise(index.join(hot.select("part", "key"), ["part", "key"], "left_semi"), "crowded-index")
    ask = materialise(probes.join(hot.select("part", "key"), ["part", "key"], "left_semi"), "crowded-probes")
    for k in range(PIVOT_ROUNDS):
        pivot = materialise(own.groupBy("part", "key").agg(F.min("fp").alias("pivot")), f"pivot-{k}")
        members = materialise(own.join(pivot, ["part", "key"]).withColumn("ball", _near("fp", "pivot")), f"members-{k}")
        asked = materialise(
            ask.join(pivot, ["part", "key"], "left").withColumn("ball", F.coalesce(_near("fp", "pivot"), F.lit(False))),
            f"asked-{k}",
        )
        star = asked.where("ball").select(F.col("pivot").alias("u"), F.col("fp").alias("v"))
        far = asked.where("not ball").select("part", "key", F.col("fp").alias("v"))
        ball = members.where("ball").select("part", "key", F.col("fp").alias("u"))
        # A probe outside the ball may still be near single members of it.
        across = _agreeing(ball, far, parts)
        edges = edges.unionByName(star).unionByName(across)
        own = members.where("not ball").select("part", "key", "fp")
        ask = asked.select("part", "key", "fp")
    rest = _agreeing(own.withColumnRenamed("fp", "u"), ask.withColumnRenamed("fp", "v"), parts).where("u < v")
    return edges.unionByName(rest).where("u <> v")


def near_duplicates(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs``."""
    rows = materialise(fingerprints(docs), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    count = nodes.count()
    sample = nodes.select("fp").orderBy(sample_order("fp")).limit(PLAN_SAMPLE).collect()
    parts = plan(np.array([r["fp"] for r in sample], dtype=np.int64).view(np.uint64), count)
    roots = connected(links(nodes, parts, crowded))
    rooted = nodes.join(roots, nodes.fp == roots.u, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    named = join_counted(rooted.drop("least"), materialise(named, "components"), "root", "size")
    names = materialise(named.select("fp", "n", "component_id"), "names")
    return join_counted(rows, names, "fp", "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates.

    The row with the smallest id of its group stays, one without an id only where
    the group has none; the row number settles ties. Groups are told apart by row
    numbers, so unrelated texts under one id or without any stay each. Columns of
    any type and name are kept.
    """
    rows, number = numbered(docs, "dedup-rows")
    ids = rows.select(F.col(number).alias("_n"), F.col("doc_id").alias("_id"))
    found = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text")).select(F.col("doc_id").alias("_n"), "component_id")
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_n")
    least = found.join(ids, "_n").groupBy("component_id").agg(F.min(order).alias("least"))
    return filter_rows(rows, number, least.select(F.col("least._n").alias(number)), keep=True)
