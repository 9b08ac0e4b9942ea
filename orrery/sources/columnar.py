"""A data source for columnar JSON: ``{"fields": [...], "data": [[...], ...]}``.

One payload may be of any size. Its bytes are cut into ranges that any task can read,
although a range may begin inside a string, a row or a nested value; a task takes several
ranges where they are short or many. That takes two passes. The first counts, in every range at once, quotes and brackets for either case of
its beginning, so that a short fold over the ranges tells each one's true state. In the
second each range reads the rows that open in it, to the end of the last one.

Files are found and read through pyarrow's file systems, on the driver and in the tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "columnar_json"
#: Bytes of a range.
RANGE_BYTES = 32 << 20
#: What opening a file counts for, in bytes, and tasks a core, where ranges are dealt to tasks.
OPEN_BYTES, TASKS_A_CORE = 64 << 10, 4
#: Rows parsed at once.
ROWS = 10_000
QUOTE, BACKSLASH = ord('"'), ord("\\")
STATE_SCHEMA = "file string, start long, flips int, outside long, inside long, least_outside long, least_inside long, lists string"
_KEYS = re.compile(rb'"(fields|data)"\s*:\s*\[')
#: A key whose list opens in a range is looked for this far before the range.
KEY_BYTES = 256
#: Bytes in which most lists of fields end.
FIELD_BYTES = 1 << 14
#: Stands for the least depth where no bracket follows.
NOTHING = 1 << 40


class BadPayload(Exception):
    """A payload without a list of fields, or one that ends too early."""


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


def files(path: str) -> list[tuple[str, int]]:
    """(address, size) of the payloads in a folder, or of one; hidden files are left out."""
    system, at = _open(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = [i for i in system.get_file_info(fs.FileSelector(at)) if i.type == fs.FileType.File]
    prefix = path.split("://", 1)[0] + "://" if "://" in path else ""
    kept = [i for i in found if not i.base_name.startswith(("_", ".")) and i.size]
    return sorted((i.path if not prefix else prefix + i.path, i.size) for i in kept)


def read_bytes(uri: str, start: int, size: int) -> bytes:
    system, at = _open(uri)
    with system.open_input_file(at) as f:
        f.seek(start)
        return f.read(size)


def escaped_start(uri: str, start: int) -> bool:
    """Whether an odd run of backslashes ends just before ``start``."""
    run, block = 0, 64
    while start - run > 0:
        lo = max(0, start - run - block)
        before = read_bytes(uri, lo, start - run - lo)
        tail = len(before) - len(before.rstrip(b"\\"))
        run += tail
        if tail < len(before):
            break
    return run % 2 == 1


def marks(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of quotes that are not escaped, of brackets, and how many quotes stand
    before each bracket."""
    quotes = np.flatnonzero(data == QUOTE)
    slash = data == BACKSLASH
    if escaped or slash.any():
        last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        run = np.zeros(len(quotes), np.int64)
        later = quotes > 0
        run[later] = quotes[later] - 1 - last[quotes[later] - 1]
        from_start = ~later
        from_start[later] = last[quotes[later] - 1] == -1
        run += from_start & escaped
        quotes = quotes[run % 2 == 0]
    low = data | 0x20  # [ and {, ] and } differ in this bit
    brackets = np.flatnonzero((low == ord("{")) | (low == ord("}")))
    return quotes, brackets, np.searchsorted(quotes, brackets)


def steps(data: np.ndarray, brackets: np.ndarray) -> np.ndarray:
    """+1 for an opening bracket, -1 for a closing one."""
    return np.where((data[brackets] | 0x20) == ord("{"), 1, -1)


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int
    in_string: bool = False
    depth: int = 0
    data_at: int = -1  # where the list of rows opens, if it reaches into the range
    names: tuple[str, ...] = ()


@dataclass
class Bundle(InputPartition):
    """The ranges of one task."""

    ranges: list[Range]


def dealt(cut: list[Range], cores: int) -> list[list[Range]]:
    """Neighbouring ranges by tasks: some tasks a core, but none of more than RANGE_BYTES,
    unless one range has more."""
    cost = [p.end - p.start + OPEN_BYTES for p in cut]
    most = min(RANGE_BYTES, sum(cost) // (cores * TASKS_A_CORE))
    out: list[list[Range]] = []
    room = 0
    for part, c in zip(cut, cost):
        if c > room:
            out.append([])
            room = max(most, c)
        out[-1].append(part)
        room -= c
    return out


def state_of(part: Range) -> tuple[str, int, int, int, int, int, int, str]:
    """What a range does to the state of the text, for either state at its start: quotes
    modulo two, then for a start outside and inside of a string the change of depth and
    its least on the way. Last, the lists named fields or data that open in the range:
    key, place, quotes modulo two before it, for either start the depth before it and
    the least depth after it, and the names in it where it is a short list of fields."""
    back = min(part.start, KEY_BYTES)
    raw = read_bytes(part.file, part.start - back, part.end - part.start + back)
    data = np.frombuffer(raw, np.uint8)[back:]
    quotes, brackets, before = marks(data, escaped_start(part.file, part.start))
    step = steps(data, brackets)
    mine = [before % 2 == k for k in (0, 1)]
    at = [brackets[m] for m in mine]
    depth = [np.cumsum(step[m]) for m in mine]
    last, least = ([int(f(d)) if len(d) else 0 for d in depth] for f in (lambda d: d[-1], np.min))
    found = []
    for m in _KEYS.finditer(raw):
        p = m.end() - 1 - back
        if p >= 0:
            up, after = [], []
            for a, d in zip(at, depth):
                k = int(np.searchsorted(a, p))
                up.append(int(d[k - 1]) if k else 0)
                rest = d[int(np.searchsorted(a, p, side="right")) :]
                after.append(int(rest.min()) if len(rest) else NOTHING)
            key = m.group(1).decode()
            named = _listed(read_bytes(part.file, part.start + p, FIELD_BYTES)) if key == "fields" else None
            found.append([key, part.start + p, int(np.searchsorted(quotes, p)) % 2, up, after, named])
    return part.file, part.start, len(quotes) % 2, last[0], last[1], least[0], least[1], json.dumps(found)


def _cell(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return json.dumps(value, separators=(",", ":"))


def rows_of(part: Range) -> Iterator[list]:
    """Lists of rows that open in a range; numbers stay as they are written."""
    if part.data_at < 0:
        return
    size = part.end - part.start
    raw = read_bytes(part.file, part.start, size)
    escaped = escaped_start(part.file, part.start)
    more = 1 << 16
    while True:
        data = np.frombuffer(raw, np.uint8)
        _, brackets, before = marks(data, escaped)
        outside = (before + part.in_string) % 2 == 0
        brackets = brackets[outside]
        after = part.depth + np.cumsum(steps(data, brackets))
        square = (data[brackets] == ord("[")) | (data[brackets] == ord("]"))
        opening = (data[brackets] | 0x20) == ord("{")
        over = np.flatnonzero((brackets > part.data_at - part.start) & (after == 1))
        end = brackets[over[0]] if len(over) else len(raw)
        opens = brackets[square & opening & (after == 3)]
        opens = opens[(opens < min(size, end)) & (opens > part.data_at - part.start)]
        if not len(opens):
            return
        closes = brackets[square & ~opening & (after == 2)]
        closes = closes[closes > opens[0]][: len(opens)]
        if len(closes) == len(opens):
            break
        further = read_bytes(part.file, part.start + len(raw), more)
        if not further:
            raise BadPayload(f"{part.file} ends inside a row")
        raw, more = raw + further, more * 2
    for k in range(0, len(opens), ROWS):
        last = min(k + ROWS, len(opens)) - 1
        text = b"[" + raw[opens[k] : closes[last] + 1] + b"]"
        yield json.loads(text, parse_int=str, parse_float=str, parse_constant=str)


class ColumnarJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        if self.options.get("mode") == "states":
            return STATE_SCHEMA
        return ", ".join(f"`{n.replace('`', '``')}` string" for n in json.loads(self.options["columns"]))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), [f.name for f in schema.fields])


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.states = options.get("mode") == "states"
        self.columns = columns
        self.ranges = options["ranges"]

    def partitions(self) -> list[Bundle]:
        names, tasks = json.loads(self.ranges)
        # The reader goes to every task; the ranges of all tasks must not go with it.
        self.ranges = ""
        return [Bundle([Range(*r, tuple(names[k])) for *r, k in task]) for task in tasks]

    def read(self, partition: Bundle) -> Iterator:
        for part in partition.ranges:
            if self.states:
                yield state_of(part)
            else:
                yield from self._batches(part)

    def _batches(self, part: Range) -> Iterator[pa.RecordBatch]:
        place = {n: k for k, n in enumerate(part.names)}
        for rows in rows_of(part):
            cols = []
            for c in self.columns:
                k = place.get(c)
                cols.append([None if k is None or k >= len(r) else _cell(r[k]) for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=self.columns)


def _listed(raw: bytes) -> list[str] | None:
    """The field names of the list that opens ``raw``, None where it does not end there;
    entries are names or objects that have one."""
    try:
        # What is cut off at the end of the text may be half a character.
        listed, _ = json.JSONDecoder().raw_decode(raw.decode(errors="ignore"))
        return [f["name"] if isinstance(f, dict) else str(f) for f in listed]
    except (json.JSONDecodeError, KeyError):
        return None


def _names(file: str, at: int) -> list[str]:
    """The field names of the list that opens at byte ``at``, however long."""
    size = FIELD_BYTES
    while True:
        raw = read_bytes(file, at, size)
        listed = _listed(raw)
        if listed is not None:
            return listed
        if len(raw) < size:
            raise BadPayload(f"the fields of {file} do not end")
        size *= 2


def _fold(cut: list[Range], states: dict) -> dict[str, tuple[str, ...]]:
    """Sets the true state at the start of every range; returns the field names by file."""
    names: dict[str, tuple[str, ...]] = {}
    file, in_string, depth, data_at = "", False, 0, -1
    for part in cut:
        if part.file != file:
            file, in_string, depth, data_at = part.file, False, 0, -1
        s = states[part.file, part.start]
        part.in_string, part.depth, part.data_at = in_string, depth, data_at
        least = depth + s["least_inside" if in_string else "least_outside"]
        for key, at, quotes, up, after, named in json.loads(s["lists"]):
            if (quotes + in_string) % 2 == 0 and depth + up[in_string] == 1:
                if key == "fields":
                    names[file] = tuple(_names(file, at) if named is None else named)
                else:
                    part.data_at = data_at = at
                    least = depth + after[in_string]
        if data_at >= 0 and least <= 1:
            data_at = -1  # closed here
        depth += s["inside" if in_string else "outside"]
        in_string ^= bool(s["flips"])
    return names


def columnar_json(
    spark: SparkSession, path: str, renames: dict[str, str] | None = None, numeric: tuple[str, ...] = (), range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The rows of all payloads under ``path``, one payload a file, as text columns.

    Columns are the fields of all payloads, in the order in which they first occur; a
    payload without one has NULL there. ``renames`` gives other names, and columns
    whose name is then in ``numeric`` become doubles, NULL where they are no number.
    """
    spark.dataSource.register(ColumnarJson)
    source = spark.read.format(NAME)
    cut = [Range(f, a, min(a + range_bytes, n)) for f, n in files(path) for a in range(0, n, range_bytes)]
    if not cut:
        raise BadPayload(f"no payload under {path}")
    tasks = dealt(cut, spark.sparkContext.defaultParallelism)

    def line() -> str:
        """The different lists of names, and by task its ranges, each with its list's place."""
        lists = list(dict.fromkeys(p.names for p in cut))
        place = {n: k for k, n in enumerate(lists)}
        return json.dumps([lists, [[[p.file, p.start, p.end, p.in_string, p.depth, p.data_at, place[p.names]] for p in t] for t in tasks]])

    # One short row per range.
    states = {(r["file"], r["start"]): r for r in source.option("mode", "states").option("ranges", line()).load().collect()}
    names = _fold(cut, states)
    for part in cut:
        if part.file not in names:
            raise BadPayload(f"{part.file} has no fields")
        part.names = names[part.file]
    columns = list(dict.fromkeys(n for p in cut for n in p.names))
    read = spark.read.format(NAME).option("ranges", line()).option("columns", json.dumps(columns)).load()
    out = []
    for n in columns:
        to, c = (renames or {}).get(n, n), F.col(f"`{n.replace('`', '``')}`")
        out.append((F.nullif(c.try_cast("double"), F.lit(float("nan"))) if to in numeric else c).alias(to))
    return read.select(*out)
