"""Two-pass external shuffle of a corpus into shards.

Pass one scatters every record uniformly into buckets by a seeded hash of a
record number; the number of buckets follows the number of records, so that a
bucket fits in memory. The buckets are written to the shared folder. Pass two
shuffles each bucket on its own (Spark's ``shuffle`` is the inside-out
Fisher-Yates shuffle, seeded) and writes it. Placing the shuffled buckets one
after another gives a random permutation of the corpus.

Law ``rows``: record number p of the permutation goes to shard p mod n, slot
p div n. So the counts of shards differ by one at most, slots have no gaps, and
copies of one text, however many, are spread evenly.

Record numbers, not ids, are hashed: repeated ids or a text that holds a third
of all rows scatter as well as any other rows. The handles of records (id, size,
checksum) go through the buckets and decide the placement, which is the same in
every run over the same partitions of ``docs``; ``write_shards`` moves the records
themselves to the shards and slots that ``place`` gives.

Defined results. Null text: size 1, checksum of the empty string. A null id is
kept. Repeated rows are placed each. Empty table: empty result. Extra columns
are ignored by ``place`` and written along by ``write_shards``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import MAX_BROADCAST_ROWS, fresh, materialise, numbered

SHARDS = 8
SEED = 20_26
#: Handles in one bucket: at least the first number; on larger tables as many as
#: there are buckets, up to the second, which still is small beside a task's memory.
BUCKET_RECORDS, MAX_BUCKET_RECORDS = 512, 65_536
#: Buckets that one task shuffles.
TASK_BUCKETS = 16
#: Buckets whose sizes are summed at once, on the way to each bucket's offset.
OFFSET_GROUP = 4096


def handles(docs: DataFrame, seed: int = SEED, number: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, row number and a random record key for every row.

    ``number`` names the column with the row number, if ``docs`` has one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.col(number) if number else F.monotonically_increasing_id()
    return docs.select(
        "doc_id",
        row.alias("_row"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit(seed), row, F.col("doc_id")).alias("record"),
    )


def place(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_records: int = BUCKET_RECORDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    return _placed(docs, shards, seed, bucket_records).drop("_row")


def _offsets(buckets: DataFrame) -> DataFrame:
    """(bucket, offset): how many records are in the buckets before each."""
    group = F.floor(F.col("bucket") / OFFSET_GROUP)
    sizes = buckets.select("bucket", "n", group.alias("g"))
    inside = F.sum("n").over(Window.partitionBy("g").orderBy("bucket")) - F.col("n")
    # One row per OFFSET_GROUP buckets, which is one in millions of records.
    totals = sizes.groupBy("g").agg(F.sum("n").alias("total"))
    before = totals.select("g", (F.sum("total").over(Window.orderBy("g")) - F.col("total")).alias("before"))
    summed = sizes.withColumn("inside", inside).join(F.broadcast(before), "g")
    return materialise(summed.select("bucket", (F.col("before") + F.col("inside")).alias("offset")), "offsets")


def _placed(docs: DataFrame, shards: int, seed: int, bucket_records: int, number: str | None = None) -> DataFrame:
    """The rows of ``place`` with the row number of each."""
    # Written first: from here on a record keeps its number whatever is lost.
    records = materialise(handles(docs, seed, number), "records")
    count = records.count()
    size = max(bucket_records, min(MAX_BUCKET_RECORDS, math.isqrt(count)))
    buckets = max(1, -(-count // size))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("record")), F.lit(buckets)).cast("int")
    scattered = records.select(bucket.alias("bucket"), F.struct("record", "doc_id", "size", "text_crc32", "_row").alias("r"))
    # A canonical order before the seeded shuffle: arrival order has no say.
    # The seeded shuffle goes by partition and by row in it, so both are fixed.
    tasks = max(1, buckets // TASK_BUCKETS)
    gathered = scattered.repartition(tasks, "bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    shuffled = materialise(
        gathered.sortWithinPartitions("bucket").select("bucket", F.size("rs").alias("n"), F.shuffle("rs", seed).alias("rs")), "buckets"
    )
    offsets = _offsets(shuffled)
    offsets = F.broadcast(offsets) if buckets <= MAX_BROADCAST_ROWS else offsets
    p = F.col("offset") + F.col("at")
    return (
        shuffled.join(offsets, "bucket")
        .select("offset", F.posexplode("rs").alias("at", "r"))
        .select(
            "r._row",
            "r.doc_id",
            "r.size",
            "r.text_crc32",
            F.lit("rows").alias("law"),
            F.pmod(p, F.lit(shards)).cast("int").alias("shard"),
            F.floor(p / shards).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_records: int = BUCKET_RECORDS
) -> str:
    """Write whole records as Parquet under ``path/shard=k``, each in the order of
    the slots that ``place`` gives; the files of a shard follow by name.

    The records are numbered in a written table, placed by their handles, and
    joined to their places by number. A shard is written by several tasks, one
    per range of its slots. Returns the name of the partition column: ``shard``,
    lengthened if the records have a column of that name.
    """
    rows, number = numbered(docs, "scatter")
    shard, slot = fresh("shard", rows.columns), fresh("_slot", rows.columns)
    placed = _placed(rows, shards, seed, bucket_records, number)
    at = materialise(placed.select(F.col("_row").alias(number), F.col("shard").alias(shard), F.col("slot").alias(slot)), "places")
    (
        rows.join(at, number)
        .repartitionByRange(shard, slot)
        .sortWithinPartitions(shard, slot)
        .drop(number, slot)
        .write.partitionBy(shard)
        .parquet(path)
    )
    return shard
