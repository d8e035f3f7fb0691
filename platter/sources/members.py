"""JSON files of any size, cut at the members of their top-level arrays or objects.

A range of bytes can't tell by itself whether it starts inside a string or how deep it is nested. So a
first pass takes, for every range, the parity of its quotes and its change of depth under both
assumptions; these few numbers per range, put one after another, give the true state at every start. The
second pass reads each range with its state and yields the members that start in it, following the last
one past its end. A file is thus read by several tasks, and a task holds one chunk and one member. Ranges get
longer where an input would have more than ``MOST_RANGES`` of them, so plan and tasks stay few.

Files are listed by Spark and read by ``pyarrow.fs``, which must know their store. Files may hold
several values one after another, all arrays or all objects. Strings that hold brackets, commas, quotes
and backslashes are told from structure; a truncated last member is yielded as it stands.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThanOrEqual, InputPartition, LessThan

SPLIT_BYTES, CHUNK = 64 << 20, 1 << 20
#: Ranges of an input beside one a file, and what is read at a time past a range's end for its last member.
MOST_RANGES, PAST_END = 2048, 16 << 10
_STEP = np.zeros(256, dtype=np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the name within it."""
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}")


def opened(path: str):
    """A file by its address, for reading anywhere."""
    system, name = located(path)
    return system.open_input_file(name)


def _escaped(file, start: int) -> bool:
    """Whether the byte at ``start`` follows an odd run of backslashes."""
    run = 0
    while start > 0:
        size = min(start, 4096)
        file.seek(start - size)
        raw = file.read(size)
        tail = len(raw) - len(raw.rstrip(b"\\"))
        run, start = run + tail, start - size
        if tail < size:
            break
    return run % 2 == 1


def _quotes(raw: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Where strings start or end, and whether the byte after ``raw`` is escaped."""
    slash = raw == 0x5C
    if not slash.any():
        quote = raw == 0x22
        if escaped and len(quote):
            quote[0] = False
        return quote, False
    at = np.arange(len(raw))
    last = np.maximum.accumulate(np.where(~slash, at, -1))  # the last byte that is no backslash
    run = np.concatenate([[0], at - last])  # backslashes right before each byte, and before what follows
    whole = np.concatenate([[True], last == -1])  # the run reaches back to the start
    odd = (run + np.where(whole, int(escaped), 0)) % 2 == 1
    return (raw == 0x22) & ~odd[:-1], bool(odd[-1])


def _chunks(file, start: int, end: int, on: bool = False) -> Iterator[np.ndarray]:
    """The bytes of a range; ``on`` goes on to the file's end in growing pieces."""
    file.seek(start)
    past = PAST_END
    while start < end or on:
        size = min(CHUNK, end - start) if start < end else past
        past = past if start < end else min(CHUNK, 2 * past)
        raw = file.read(size)
        if not raw:
            return
        start += len(raw)
        yield np.frombuffer(raw, dtype=np.uint8)


def range_state(path: str, start: int, end: int) -> tuple[int, int, int]:
    """Parity of the quotes in a range, and its change of depth if it starts outside and inside a string."""
    with opened(path) as file:
        escaped, odd, outside, inside = _escaped(file, start), 0, 0, 0
        for raw in _chunks(file, start, end):
            quote, escaped = _quotes(raw, escaped)
            within = (np.cumsum(quote) + odd) % 2 == 1
            step = _STEP[raw]
            outside, inside = outside + int(step[~within].sum()), inside + int(step[within].sum())
            odd = (odd + int(quote.sum())) % 2
    return odd, outside, inside


def range_members(path: str, start: int, end: int, in_string: bool, depth: int) -> Iterator[bytes]:
    """The members of top-level values whose leading bracket or comma lies in the range."""
    with opened(path) as file:
        escaped, held, position = _escaped(file, start), None, start  # held: the bytes of an open member
        for raw in _chunks(file, start, end, on=True):
            quote, escaped = _quotes(raw, escaped)
            within = (np.cumsum(quote) + int(in_string)) % 2 == 1
            in_string = bool(within[-1])
            step = np.where(within, 0, _STEP[raw])
            level = depth + np.cumsum(step)
            depth = int(level[-1])
            marks = ~within & (((raw == 0x2C) & (level == 1)) | ((step == 1) & (level == 1)) | ((step == -1) & (level == 0)))
            before = 0
            for at in np.flatnonzero(marks).tolist():
                if held is not None:
                    held.append(raw[before:at].tobytes())
                    member = b"".join(held).strip()
                    if member:
                        yield member
                closing = step[at] == -1
                if position + at >= end:
                    return
                held, before = None if closing else [], at + 1
            if held is not None:
                held.append(raw[before:].tobytes())
            position += len(raw)
            if held is None and position >= end:
                return
        if held and b"".join(held).strip():
            yield b"".join(held).strip()


def planned_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> list[tuple[str, int, int, bool, int]]:
    """``path, start, end, in_string, depth`` of every range of all files; a few numbers per range reach the driver.

    A range has ``split_bytes``, or the share of all bytes that leaves ``MOST_RANGES`` if that is more.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # lists, without reading
    split_bytes = max(split_bytes, -(-(files.agg(F.sum("length")).first()[0] or 0) // MOST_RANGES))
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = files.filter("length > 0").select("path", F.explode(cuts).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("end"))
    ranges = ranges.repartition(max(spark.sparkContext.defaultParallelism, 1), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(*r, *range_state(*r)) for r in zip(*(c.to_pylist() for c in batch.columns))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["path", "start", "end", "odd", "outside", "inside"])

    states = ranges.mapInArrow(run, "path string, start long, end long, odd long, outside long, inside long").collect()
    out, here, in_string, depth = [], None, False, 0
    for row in sorted(states, key=lambda r: (r["path"], r["start"])):
        if row["path"] != here:
            here, in_string, depth = row["path"], False, 0
        out.append((here, row["start"], row["end"], in_string, depth))
        depth += row["inside"] if in_string else row["outside"]
        in_string ^= bool(row["odd"])
    return out


def json_members(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``value``: the members of all top-level arrays as JSON, or those of objects as objects of one member."""
    plan = planned_ranges(spark, path, split_bytes)
    if not plan:
        return spark.createDataFrame([], "value string")
    ranges = spark.createDataFrame(plan, "path string, start long, end long, in_string boolean, depth long").repartition(min(len(plan), MOST_RANGES), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(own[0]) as file:
                    pairs = file.read(4096).lstrip(b"\xef\xbb\xbf \t\r\n").startswith(b"{")
                held, size = [], 0
                for member in range_members(*own):
                    text = member.decode("utf-8", "replace")
                    held.append("{" + text + "}" if pairs else text)
                    size += len(text)
                    if size >= CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    return ranges.mapInArrow(run, "value string")


class _Range(InputPartition):
    def __init__(self, *own):
        self.own = own


class CaptureIndexReader(DataSourceReader):
    """Rows of planned ranges."""

    NAMES = ("timestamp", "original", "digest", "statuscode", "mimetype")

    def __init__(self, options):
        self.plan = [tuple(own) for own in json.loads(options["plan"])]
        self.tests: list[tuple[int, str, str]] = []

    def partitions(self):
        return [_Range(*own) for own in self.plan]

    def read(self, partition):
        for member in range_members(*partition.own):
            try:
                cells = json.loads(member)
            except ValueError:
                continue
            if not isinstance(cells, list) or cells[:1] == ["timestamp"]:
                continue
            row = tuple(None if x is None else str(x) for x in [*cells, *[None] * 5][:5])
            if all(row[k] is not None and (row[k] == v if how == "=" else row[k] >= v if how == ">=" else row[k] < v) for k, how, v in self.tests):
                yield row


class FilteringReader(CaptureIndexReader):
    """Conditions on timestamp, status and type are met while reading."""

    def pushFilters(self, filters):
        """Takes equal, at least and less than a string on the three columns; the rest stays with Spark."""
        kinds = {EqualTo: "=", GreaterThanOrEqual: ">=", LessThan: "<"}
        for f in filters:
            name = getattr(f, "attribute", ("",))[-1]
            if type(f) in kinds and name in ("timestamp", "statuscode", "mimetype") and isinstance(f.value, str):
                self.tests.append((self.NAMES.index(name), kinds[type(f)], f.value))
            else:
                yield f


class CaptureIndexSource(DataSource):
    """``spark.read.format("capture_index").option("plan", ...)``: a capture index by planned byte ranges."""

    @classmethod
    def name(cls):
        return "capture_index"

    def schema(self):
        return ", ".join(f"{n} string" for n in CaptureIndexReader.NAMES)

    def reader(self, schema):
        return (FilteringReader if self.options.get("pushdown") == "true" else CaptureIndexReader)(self.options)


def capture_index(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A capture index (arrays of arrays, each with or without a header row) as named string columns.

    Conditions are pushed into the reader where the session has ``spark.sql.python.filterPushdown.enabled`` on.
    """
    spark.dataSource.register(CaptureIndexSource)
    plan, pushdown = json.dumps(planned_ranges(spark, path, split_bytes)), spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("capture_index").option("plan", plan).option("pushdown", pushdown).load()
