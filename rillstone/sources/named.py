"""The ride and fare files as named sources: ``spark.read.format("taxi-rides").option("path", ...)``, batch and streaming.

Every file is a partition, read where its task runs; its lines are handed on as they are and parsed by columns
(:func:`read_named`). Options are checked before anything is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from rillstone.operators.events import with_event_time
from rillstone.sources.lines import parse_fare_lines, parse_ride_lines

OPTIONS = ("path", "maxEventDelaySecs")
_LINES_AT_A_TIME = 10_000


def _checked(options: dict) -> tuple[str, int]:
    """Path and largest event delay in seconds; names of options count in any case."""
    low = {k.lower(): v for k, v in options.items()}
    unknown = sorted(set(low) - {o.lower() for o in OPTIONS})
    if unknown:
        raise ValueError(f"unknown option: {', '.join(unknown)}")
    if not low.get("path"):
        raise ValueError("option path is required")
    text = low.get("maxeventdelaysecs", "0")
    if not text.isdecimal():
        raise ValueError("option maxEventDelaySecs must be a whole number of at least 0")
    return low["path"], int(text)


def _files(path: str) -> list[tuple[int, str]]:
    """(time of change in ns, path) of a file or of all files of a folder, oldest first; hidden ones are left out."""
    fs, root = pafs.FileSystem.from_uri(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise ValueError(f"path does not exist: {path}")
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root))
    return sorted((f.mtime_ns or 0, f.path) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._")


class _File(InputPartition):
    pass


def _lines(path: str, file: str) -> Iterator[pa.RecordBatch]:
    """The lines of a file, unzipped by its ending."""
    fs, _ = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(file, compression="detect") as raw:
        held, rest = [], b""
        while block := raw.read(1 << 20):
            *whole, rest = (rest + block).split(b"\n")
            held += whole
            while len(held) >= _LINES_AT_A_TIME:
                yield _batch(held[:_LINES_AT_A_TIME])
                held = held[_LINES_AT_A_TIME:]
        if rest:
            held.append(rest)
        if held:
            yield _batch(held)


def _batch(lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.removesuffix(b"\r").decode() for x in lines], pa.string())], ["value"])


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for _, f in _files(self.path)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _lines(self.path, partition.value)


class _StreamReader(DataSourceStreamReader):
    """Files in the order they were written; an offset names the last one of a batch."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"changed": -1, "file": ""}

    def latestOffset(self) -> dict:
        files = _files(self.path)
        return {"changed": files[-1][0], "file": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = ((o["changed"], o["file"]) for o in (start, end))
        return [_File(f) for at, f in _files(self.path) if low < (at, f) <= high]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _lines(self.path, partition.value)


class TaxiRides(DataSource):
    """Lines of ride events."""

    @classmethod
    def name(cls) -> str:
        return "taxi-rides"

    def schema(self) -> str:
        return "value STRING"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_checked(self.options)[0])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_checked(self.options)[0])


class TaxiFares(TaxiRides):
    """Lines of fares."""

    @classmethod
    def name(cls) -> str:
        return "taxi-fares"


def read_named(spark: SparkSession, name: str, streaming: bool = False, **options: str) -> DataFrame:
    """Typed events with ``event_time`` from ``taxi-rides`` or ``taxi-fares``; a stream has the largest delay as its watermark's."""
    for source in (TaxiRides, TaxiFares):
        spark.dataSource.register(source)
    _, delay = _checked(options)
    reader = (spark.readStream if streaming else spark.read).format(name)
    lines = reader.options(**options).load()
    if name == TaxiRides.name():
        events = with_event_time(parse_ride_lines(lines))
    else:
        events = parse_fare_lines(lines).withColumn("event_time", F.col("start_time"))
    return events.withWatermark("event_time", f"{delay} seconds") if streaming else events
