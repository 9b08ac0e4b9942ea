"""What the operators of this subpackage share: scratch tables and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.plans.staging import staged as materialise  # noqa: F401  (each step of this subpackage writes by it)

#: White space between words in the contracts: the space and code points 9 to 13.
BLANK = r"[\x20\x09-\x0D]"

#: Bitmaps of 32,768 row numbers, 4 KB each, up to which a set of rows is broadcast:
#: 256 MB, or up to two billion rows. Beyond it the set is joined by a shuffle.
MAX_BITMAPS = 65_536
#: Narrow rows that are broadcast at once.
MAX_BROADCAST_ROWS = 500_000


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a row number in a column of its own, written, so that a row keeps
    its number; and that column's name.

    Decisions are joined by it: ids may be null or repeat.
    """
    number = fresh("_row", docs.columns)
    return materialise(docs.withColumn(number, F.monotonically_increasing_id()), name), number


def mark_rows(rows: DataFrame, number: str, chosen: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: the row's number is among ``chosen`` (number).

    The set of chosen numbers becomes bitmaps, one bit a row, whose counted size
    allows them to be broadcast; so whole texts are not shuffled to learn of a
    decision. A larger set is joined by a shuffle, with the same result.
    """
    n = F.col(number)
    bucket, bits = fresh("_bucket", rows.columns), fresh("_bits", rows.columns)
    sets = chosen.groupBy(F.bitmap_bucket_number(n).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(bits))
    sets = materialise(sets, "row-sets")
    if sets.count() > MAX_BITMAPS:
        listed = chosen.select(number).distinct().withColumn(flag, F.lit(True))
        return rows.join(listed, number, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    at = F.bitmap_bit_position(n).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    joined = rows.join(F.broadcast(sets), F.bitmap_bucket_number(n) == F.col(bucket), "left")
    return joined.select(*rows.columns, F.coalesce(bit, F.lit(False)).alias(flag))


def filter_rows(rows: DataFrame, number: str, chosen: DataFrame, keep: bool) -> DataFrame:
    """The rows whose number is among ``chosen`` if ``keep``, else the others, without
    the number."""
    flag = fresh("_chosen", rows.columns)
    marked = mark_rows(rows, number, chosen, flag)
    return marked.where(F.col(flag) if keep else ~F.col(flag)).drop(flag, number)


def join_parts(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to a written ``table`` of narrow rows, broadcast.

    A table of more than MAX_BROADCAST_ROWS rows is broadcast in parts of about so
    many, one after another, so that rows of a hot key stay where they are at any
    size of the table. ``how`` is inner, or left_semi with a table of distinct keys.
    """
    parts = -(-table.count() // MAX_BROADCAST_ROWS)
    if parts <= 1:
        return rows.join(F.broadcast(table), on, how)
    part = F.pmod(F.xxhash64(F.lit("part"), *table.columns), F.lit(parts))
    out = [rows.join(F.broadcast(table.where(part == k)), on, how) for k in range(parts)]
    while len(out) > 1:  # unions in a balanced tree
        out = [a.unionByName(b) for a, b in zip(out[::2], out[1::2])] + (out[-1:] if len(out) % 2 else [])
    return out[0]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Boolean Column: crc32 of the id as text falls in the held-out part.

    A null id counts as held out, so it is never learned from.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(True))


def sample_order(*cols) -> Column:
    """A fixed pseudo-random order: the same rows whatever the partitioning."""
    return F.xxhash64(F.lit("sample"), *cols)


def hash_edge(share: float) -> int:
    """The signed 64-bit value with ``share`` of all hashes at or below it."""
    return max(-(2**63), min(2**63 - 1, int(share * 2**64) - 2**63))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` does the same on pure ASCII and is much cheaper there; other
    texts go through ``translate``, which leaves every other letter alone.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, upper, upper.lower())
    )
