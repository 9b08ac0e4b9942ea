"""A data source for delimited files that filters and cuts to the first rows where it reads.

A file with a header is cut into ranges of bytes, each a task. The schema that the reader
is given is the projection: other columns are not converted. Filters that Spark pushes are
applied to each block of rows as it is parsed. With ``n`` and ``order`` a task keeps no
more than the first n rows of its range, block after block, so n rows leave it at most;
Spark then takes the first n of these. Values hold no line breaks.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orrery.sources.columnar import files, read_bytes
from orrery.sources.readers import MissingColumn

NAME = "delimited_first"
#: Bytes of a range, and of a block that is parsed at once.
RANGE_BYTES, BLOCK_BYTES = 64 << 20, 8 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_COMPARE = {
    D.EqualTo: pc.equal,
    D.GreaterThan: pc.greater,
    D.GreaterThanOrEqual: pc.greater_equal,
    D.LessThan: pc.less,
    D.LessThanOrEqual: pc.less_equal,
}


@dataclass
class Lines(D.InputPartition):
    """The lines of a file that begin in a range of its bytes."""

    file: str
    start: int
    end: int


def header(file: str) -> list[str]:
    raw, size = b"", 1 << 12
    while b"\n" not in raw:
        raw = read_bytes(file, 0, size)
        if len(raw) < size:
            break
        size *= 2
    line = raw.split(b"\n", 1)[0].rstrip(b"\r").removeprefix(b"\xef\xbb\xbf")
    return csv.read_csv(io.BytesIO(line + b"\n")).column_names if line else []


def blocks(part: Lines) -> Iterator[bytes]:
    """Whole lines that begin in a range, a block at a time."""
    # A line begins in the range if the break before it ends at or after its start.
    at = part.start - 1 if part.start else 0
    raw = b""
    skip = part.start > 0
    while True:
        chunk = read_bytes(part.file, at + len(raw), BLOCK_BYTES)
        raw += chunk
        if skip:
            cut = raw.find(b"\n")
            if cut < 0:
                if not chunk:
                    return
                continue
            at, raw, skip = at + cut + 1, raw[cut + 1 :], False
        if at >= part.end:
            return
        inside = part.end - at
        if len(raw) >= inside:  # the last line of the range may end beyond it
            cut = raw.find(b"\n", inside - 1)
            if cut >= 0 or not chunk:
                yield raw[: cut + 1] if cut >= 0 else raw
                return
            continue
        cut = raw.rfind(b"\n") + 1
        if not chunk:
            if raw:
                yield raw
            return
        if cut:
            yield raw[:cut]
            at, raw = at + cut, raw[cut:]


def matches(table: pa.Table, filters: list[D.Filter]) -> pa.Table:
    """Rows for which every filter is true; what is unknown is not true."""

    def holds(f: D.Filter):
        if isinstance(f, D.Not):
            return pc.invert(holds(f.child))
        column = table[f.attribute[0]]
        if isinstance(f, D.IsNotNull):
            return pc.is_valid(column)
        if isinstance(f, D.IsNull):
            return pc.is_null(column)
        if isinstance(f, D.In):
            # A missing value is in no list and not outside one.
            return pc.if_else(pc.is_valid(column), pc.is_in(column, pa.array(list(f.value), column.type)), pa.scalar(None, pa.bool_()))
        return _COMPARE[type(f)](column, pa.scalar(f.value, column.type))

    for f in filters:
        table = table.filter(holds(f))
    return table


def supported(f: D.Filter) -> bool:
    if isinstance(f, D.Not):
        return supported(f.child)
    one = len(getattr(f, "attribute", ())) == 1
    if isinstance(f, (D.IsNotNull, D.IsNull)):
        return one
    if isinstance(f, D.In):
        return one and all(v is not None for v in f.value)
    return one and type(f) in _COMPARE and f.value is not None


class DelimitedFirst(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> D.DataSourceReader:
        return _Reader(dict(self.options), schema)


class _Reader(D.DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.schema = to_arrow_schema(schema)
        self.cut = [Lines(*r) for r in json.loads(options["ranges"])]
        self.first = int(options.get("n", 0))
        self.order = json.loads(options.get("order", "[]"))
        self.filters: list[D.Filter] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:  # noqa: N802  (the interface's name)
        for f in filters:
            if supported(f):
                self.filters.append(f)
            else:
                # What Spark drops later must not have taken the place of other rows.
                self.first = 0
                yield f

    def partitions(self) -> list[Lines]:
        return self.cut

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        names = header(partition.file)
        wanted = self.schema.names
        kinds = dict(zip(wanted, self.schema.types))
        convert = csv.ConvertOptions(column_types=kinds, include_columns=wanted, null_values=[""], strings_can_be_null=True)
        best: pa.Table | None = None
        for k, block in enumerate(blocks(partition)):
            if k == 0 and partition.start == 0:
                block = block.split(b"\n", 1)[1] if b"\n" in block else b""
            if not block.strip():
                continue
            table = csv.read_csv(io.BytesIO(block), csv.ReadOptions(column_names=names), convert_options=convert)
            table = matches(table, self.filters).cast(self.schema)
            if not self.first:
                yield from table.to_batches()
                continue
            both = table if best is None else pa.concat_tables([best, table])
            keys = [(c, "ascending") for c in dict.fromkeys([*self.order, *wanted])]
            best = both.take(pc.sort_indices(both, keys, null_placement="at_end")[: self.first])
        if best is not None:
            yield from best.combine_chunks().to_batches()


def delimited_first(
    spark: SparkSession, path: str, schema: T.StructType, first_column: str, n: int = 0, order: tuple[str, ...] = (), range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The columns of ``schema`` of the files under ``path``, whose headers must begin with
    ``first_column``; only "" is NULL.

    ``n`` is how many rows by ``order``, then by all columns, nulls last, the caller will
    take of what the filters on the result leave (see ``first_rows``); 0 reads all. Turns
    on the session's filter push-down for sources in Python.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(DelimitedFirst)
    found = files(path)
    for f, _ in found:
        names = header(f)
        if not names or names[0] != first_column:
            raise MissingColumn(f"the header of {f} does not begin with {first_column}")
        if missing := [c for c in schema.names if c not in names]:
            raise MissingColumn(f"{f} has no {', '.join(missing)}")
    cut = [[f, a, min(a + range_bytes, size)] for f, size in found for a in range(0, size, range_bytes)]
    source = spark.read.format(NAME).schema(schema).option("ranges", json.dumps(cut))
    return source.option("n", n).option("order", json.dumps(list(order))).load()


def first_rows(df: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """The first n rows by ``order``, then by all columns, nulls last."""
    keys = list(dict.fromkeys([*order, *df.columns]))
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).limit(n)
