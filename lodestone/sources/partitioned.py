"""Readers whose partitions are planned, and a writer that commits, as Python data sources.

lines_by_range   JSON lines, cut into ranges of bytes: a range owns the lines that start in it, wherever they end
sqlite_by_rowid  a SQLite table, cut into ranges of rowid; comparisons with a constant are pushed into its query
rotating_lines   JSON lines in parts that are closed by bytes; parts appear when all tasks are done, and a failed task leaves none

Paths are ones that every executor opens alike (a shared folder), or any that pyarrow's file systems know.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .shared import ship

RANGE_BYTES = 64 << 20
RANGE_ROWS = 1 << 20
PART_BYTES = 64 << 20
#: Rows and characters of a batch that is read, and rows that are Python objects at a time when written.
BATCH, BATCH_CHARS = 4096, 4 << 20
AT_ONCE = 64


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[fs.FileInfo]:
    """The files at a path or below it, but for hidden ones."""
    system, at = _open(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File and not any(p.startswith(("_", ".")) for p in f.path[len(at) :].split("/"))), key=lambda f: f.path)


@dataclass
class Bytes(InputPartition):
    path: str
    start: int
    end: int


def lines_of_range(file, start: int, end: int) -> Iterator[bytes]:
    """The lines that start in bytes start..end of a seekable file, without their ends. A line starts at 0, or after a newline."""
    if start:
        file.seek(start - 1)
        at = start - 1 + len(file.readline())  # the rest of the line that an earlier range owns, or the newline before
    else:
        at = 0
    while at < end:
        line = file.readline()
        if not line:
            return
        at += len(line)
        yield line.rstrip(b"\n")


def _batches(rows: Iterator[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) == BATCH or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


class _RangeReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, size: int):
        self.schema, self.path, self.size = to_arrow_schema(schema), path, size

    def partitions(self) -> list[InputPartition]:
        return [Bytes(f.path, at, min(at + self.size, f.size)) for f in _files(self.path) for at in range(0, f.size, self.size)] or [Bytes("", 0, 0)]

    def read(self, partition: Bytes) -> Iterator[pa.RecordBatch]:
        import io

        if not partition.path:
            return
        system, _ = _open(self.path)
        with system.open_input_file(partition.path) as raw:
            file = io.BufferedReader(pa.PythonFile(raw) if not hasattr(raw, "readinto") else raw, 1 << 20)
            rows = ([json.loads(line).get(f.name) for f in self.schema] for line in lines_of_range(file, partition.start, partition.end) if line.strip())
            yield from _batches(rows, self.schema)


class RangeLines(DataSource):
    """Options: path, bytes (of a range). The schema is given by the caller."""

    @classmethod
    def name(cls) -> str:
        return "lines_by_range"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RangeReader(schema, self.options["path"], int(self.options.get("bytes", RANGE_BYTES)))


@dataclass
class Rowids(InputPartition):
    start: int
    end: int


class _SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, table: str, rows: int):
        self.schema, self.path, self.table, self.rows = to_arrow_schema(schema), path, table, rows
        self.where: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        signs = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            plain = type(f) in signs and len(f.attribute) == 1 and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool)
            if plain and not (isinstance(f.value, float) and f.value != f.value):
                self.where.append((f.attribute[0], signs[type(f)], f.value))
            else:
                yield f

    def _connect(self):
        import sqlite3

        return sqlite3.connect(f"file:{_open(self.path)[1]}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._connect() as c:
            low, high = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        return [Rowids(at, at + self.rows) for at in range(low, high + 1, self.rows)] if low is not None else [Rowids(0, 0)]

    def read(self, partition: Rowids) -> Iterator[pa.RecordBatch]:
        names = ", ".join(f'"{f.name}"' for f in self.schema)
        more = "".join(f' AND "{c}" {sign} ?' for c, sign, _ in self.where)
        with self._connect() as c:
            cursor = c.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?{more}', [partition.start, partition.end, *(v for *_, v in self.where)])
            yield from _batches(iter(cursor), self.schema)


class RowidTable(DataSource):
    """Options: path, table, rows (of a range of rowid). The schema is given by the caller."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_by_rowid"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(schema, self.options["path"], self.options["table"], int(self.options.get("rows", RANGE_ROWS)))


@dataclass
class Parts(WriterCommitMessage):
    staged: list[str]
    rows: int


def _plain(x):
    if isinstance(x, datetime.datetime) and x.tzinfo:
        x = x.astimezone().replace(tzinfo=None)  # the worker's own clock
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    return x.hex() if isinstance(x, (bytes, bytearray)) else str(x)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """A JSON line a row; few rows of a batch are Python objects at a time."""
    for batch in batches:
        names = batch.schema.names
        for at in range(0, batch.num_rows, AT_ONCE):
            for row in zip(*(c.to_pylist(maps_as_pydicts="strict") for c in batch.slice(at, AT_ONCE).columns)):
                yield (json.dumps(dict(zip(names, row)), ensure_ascii=False, separators=(",", ":"), default=_plain) + "\n").encode()


class _RotatingWriter(DataSourceArrowWriter):
    def __init__(self, path: str, size: int):
        self.path, self.size, self.write_id = path, size, uuid.uuid4().hex

    def _stage(self) -> str:
        return f"{_open(self.path)[1].rstrip('/')}/_staged-{self.write_id}"

    def write(self, iterator) -> Parts:
        from pyspark import TaskContext

        system, _ = _open(self.path)
        task = TaskContext.get()
        folder, staged, out, held, rows = self._stage(), [], None, 0, 0
        system.create_dir(folder)
        try:
            for line in _lines(iterator):
                if out is not None and held + len(line) > self.size:
                    out.close()
                    out = None
                if out is None:
                    # an attempt has names of its own, so that one that failed or ran twice is never taken for another
                    staged.append(f"{folder}/part-{task.partitionId():05d}-{len(staged):05d}-{task.taskAttemptId()}.jsonl")
                    out, held = system.open_output_stream(staged[-1]), 0
                out.write(line)
                held += len(line)
                rows += 1
        finally:
            if out is not None:
                out.close()
        return Parts(staged, rows)

    def commit(self, messages) -> None:
        system, root = _open(self.path)
        for part in sorted(p for m in messages if m is not None for p in m.staged):
            system.move(part, f"{root.rstrip('/')}/{part.rsplit('/', 1)[1]}")
        self._clear(system)

    def abort(self, messages) -> None:
        self._clear(_open(self.path)[0])

    def _clear(self, system: fs.FileSystem) -> None:
        if system.get_file_info(self._stage()).type != fs.FileType.NotFound:
            system.delete_dir(self._stage())


class RotatingLines(DataSource):
    """Options: path, bytes (of a part at most; a longer line is a part of its own). Appends."""

    @classmethod
    def name(cls) -> str:
        return "rotating_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("rotating_lines appends: use mode('append')")
        return _RotatingWriter(self.options["path"], int(self.options.get("bytes", PART_BYTES)))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (RangeLines, RowidTable, RotatingLines):
        spark.dataSource.register(source)


def read_lines(spark: SparkSession, path: str, schema: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """JSON lines under a path; a task reads one range of bytes."""
    register(spark)
    return spark.read.format("lines_by_range").schema(schema).option("path", path).option("bytes", range_bytes).load()


def read_table(spark: SparkSession, path: str, table: str, schema: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """A SQLite table; a task reads one range of rowid."""
    register(spark)
    return spark.read.format("sqlite_by_rowid").schema(schema).option("path", path).option("table", table).option("rows", range_rows).load()


def write_lines(df: DataFrame, path: str, part_bytes: int = PART_BYTES) -> None:
    """Append rows as JSON lines in parts of at most `part_bytes`; all appear, or none."""
    register(df.sparkSession)
    df.write.format("rotating_lines").mode("append").option("path", path).option("bytes", part_bytes).save()
