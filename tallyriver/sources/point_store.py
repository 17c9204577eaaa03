"""A table of time-series points as a data source of its own, for batches and streams.

``register(spark)`` makes it known; then

    points.write.format("points").mode("append").save(path)
    spark.read.format("points").load(path).filter("time >= ... and measurement = ...")
    stream.writeStream.format("points").option("path", path).option("writer", "main").option("checkpointLocation", ...)
    spark.readStream.format("points").load(path)

Tasks write Parquet files below ``data``; a file counts once a commit lists it.
The commits of a writer are numbered files below ``log/<writer>``. So a reader
sees all points of a commit or none, a failed or repeated task leaves none, and
a micro-batch that is repeated finds its commit and counts once. A commit keeps
the number of rows and the range of times and measurements of its files:
filters on ``time`` and ``measurement`` leave out files, and within a file row
groups. Files are narrow in time if the points are dealt out by time before
they are written (``by_time``) or come from a stream in order.

Every ``fold_every`` commits a writer's log is folded into a base, and the
commits before the base before are removed, so a log has a bounded number of
files. Points are appended as they are; ``points.merge_points`` merges them.

A writer's name stands for one stream with its checkpoint, or for batch writes
one after the other: two at once need two names. Needs a file system that
pyarrow knows, such as a local one, HDFS or S3.
"""

from __future__ import annotations

import json
import re
import sys
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as DS
from pyspark.sql.types import StructType

from tallyriver.schemas import POINT_SCHEMA

FORMAT = "points"
ROWS_PER_FILE = 1_000_000
ROWS_PER_PARTITION = 200_000
BATCH_ROWS = 16_384
FOLD_EVERY = 100


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it.

    The code of this module travels with it, so that workers need not have the library.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PointSource)


def by_time(points: DataFrame, partitions: int | None = None) -> DataFrame:
    """The points dealt out by ranges of time, so that every file is narrow in time."""
    return points.repartitionByRange(partitions, "time") if partitions else points.repartitionByRange("time")


# --- files -----------------------------------------------------------------


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path).rstrip("/")
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs, inner.rstrip("/")


@dataclass(frozen=True)
class File:
    """A data file as its commit lists it: times in microseconds; None if all are null."""

    name: str
    rows: int
    first: int | None
    last: int | None
    least: str | None
    greatest: str | None


@dataclass
class Written(DS.WriterCommitMessage):
    files: list[File] = field(default_factory=list)


@dataclass
class Bounds:
    """What filters say: times from ``first`` to ``last`` (both included) and one measurement; None says nothing."""

    first: int | None = None
    last: int | None = None
    measurement: str | None = None

    def may_hold(self, f: File) -> bool:
        if (self.first is not None or self.last is not None) and f.first is None:
            return False
        if self.first is not None and f.last < self.first or self.last is not None and f.first > self.last:
            return False
        return self.measurement is None or (f.least is not None and f.least <= self.measurement <= f.greatest)

    def expression(self) -> ds.Expression | None:
        """The same for rows: row groups beyond the bounds are not read."""
        parts = []
        kind = pa.timestamp("us", "UTC")
        if self.first is not None:
            parts.append(ds.field("time") >= pa.scalar(self.first, pa.int64()).cast(kind))
        if self.last is not None:
            parts.append(ds.field("time") <= pa.scalar(self.last, pa.int64()).cast(kind))
        if self.measurement is not None:
            parts.append(ds.field("measurement") == self.measurement)
        whole = None
        for part in parts:
            whole = part if whole is None else whole & part
        return whole


# --- the log ---------------------------------------------------------------


class Log:
    """The commits of one writer: ``N.json`` lists the files of commit N, ``N.base`` those of all commits up to N."""

    def __init__(self, path: str, writer: str):
        self.fs, self.root = _open(path)
        self.folder = f"{self.root}/log/{writer}"

    def _numbers(self) -> tuple[list[int], list[int]]:
        found = self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        names = [re.fullmatch(r"(\d+)\.(json|base)", f.base_name) for f in found]
        kinds = {kind: sorted(int(m[1]) for m in names if m and m[2] == kind) for kind in ("json", "base")}
        return kinds["json"], kinds["base"]

    def next(self) -> int:
        commits, bases = self._numbers()
        return max([*commits, *bases], default=-1) + 1

    def holds(self, number: int) -> bool:
        commits, bases = self._numbers()
        return number in commits or bool(bases) and number <= bases[-1]

    def _read(self, name: str) -> list[tuple[int, File]]:
        with self.fs.open_input_stream(f"{self.folder}/{name}") as f:
            return [(number, File(*entry)) for number, *entry in json.loads(f.readall())]

    def _write(self, name: str, entries: Iterable[tuple[int, File]]) -> None:
        """The whole file appears at once."""
        rows = [[n, f.name, f.rows, f.first, f.last, f.least, f.greatest] for n, f in entries]
        draft = f"{self.folder}/.{name}-{uuid.uuid4().hex}"
        self.fs.create_dir(self.folder, recursive=True)
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(rows).encode())
        self.fs.move(draft, f"{self.folder}/{name}")

    def entries(self, start: int = 0, end: int | None = None) -> list[tuple[int, File]]:
        """Files of the commits from ``start`` to before ``end``."""
        commits, bases = self._numbers()
        found: list[tuple[int, File]] = []
        if bases and start <= bases[-1]:
            found = self._read(f"{bases[-1]}.base")
        after = bases[-1] if bases else -1
        for number in commits:
            if number > after and number >= start and (end is None or number < end):
                found.extend(self._read(f"{number}.json"))
        return [(n, f) for n, f in found if n >= start and (end is None or n < end)]

    def commit(self, number: int, files: Sequence[File], fold_every: int) -> None:
        self._write(f"{number}.json", [(number, f) for f in files])
        if number % fold_every != fold_every - 1:
            return
        self._write(f"{number}.base", self.entries())
        commits, bases = self._numbers()
        # readers that have listed the folder before still find what the base before needs
        if len(bases) > 1:
            for old in commits:
                if old <= bases[-2]:
                    self.fs.delete_file(f"{self.folder}/{old}.json")
            for old in bases[:-2]:
                self.fs.delete_file(f"{self.folder}/{old}.base")


def _writers(path: str) -> list[str]:
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/log", allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory)


def remove_unlisted(path: str, older_than: float = 86_400.0) -> int:
    """Delete data files that no commit lists, left by tasks that were killed; returns how many.

    Younger ones (in seconds) stay, as their commit may be on its way.
    """
    fs, root = _open(path)
    listed = {f.name for w in _writers(path) for _, f in Log(path, w).entries()}
    now, removed = time.time(), 0
    for f in fs.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True)):
        if f.base_name not in listed and now - f.mtime.timestamp() >= older_than:
            fs.delete_file(f.path)
            removed += 1
    return removed


# --- writing ---------------------------------------------------------------


class _Task:
    """What one task writes: a file of at most ``rows_per_file`` points after the other, one batch in memory."""

    def __init__(self, path: str, rows_per_file: int, job: str = "s"):
        self.path, self.rows_per_file, self.job = path, rows_per_file, job

    def run(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, root = _open(self.path)
        fs.create_dir(f"{root}/data", recursive=True)
        schema = to_arrow_schema(POINT_SCHEMA)
        done: list[File] = []
        names: list[str] = []
        out, ranges, rows = None, [], 0

        def close() -> None:
            nonlocal out, ranges, rows
            if out is None:
                return
            out.close()
            bounds = [_least_and_greatest([r[k] for r in ranges]) for k in (0, 1)]
            done.append(File(names[-1], rows, *bounds[0], *bounds[1]))
            out, ranges, rows = None, [], 0

        try:
            for batch in batches:
                table = pa.Table.from_batches([batch]).select(POINT_SCHEMA.names).cast(schema)
                at = 0
                while at < table.num_rows:
                    if out is None:
                        names.append(f"{self.job}-{uuid.uuid4().hex}.parquet")
                        out = pq.ParquetWriter(f"{root}/data/{names[-1]}", schema, filesystem=fs)
                    part = table.slice(at, self.rows_per_file - rows)
                    out.write_table(part)
                    ranges.append((_range(part["time"].cast(pa.int64())), _range(part["measurement"])))
                    at, rows = at + part.num_rows, rows + part.num_rows
                    if rows >= self.rows_per_file:
                        close()
            close()
        except BaseException:
            if out is not None:
                out.close()
            _delete(self.path, names)
            raise
        return Written(done)


def _range(column: pa.ChunkedArray) -> tuple:
    ends = pc.min_max(column)
    return ends["min"].as_py(), ends["max"].as_py()


def _least_and_greatest(ranges: list[tuple]) -> tuple:
    known = [r for r in ranges if r[0] is not None]
    return (min(r[0] for r in known), max(r[1] for r in known)) if known else (None, None)


def _delete(path: str, names: Iterable[str]) -> None:
    fs, root = _open(path)
    for name in names:
        try:
            fs.delete_file(f"{root}/data/{name}")
        except FileNotFoundError:
            pass


def _files(messages: Iterable[Written | None]) -> list[File]:
    return [f for m in messages if m is not None for f in m.files]


class _Settings:
    def __init__(self, options: dict[str, str], stream: bool):
        self.path = options["path"]
        self.writer = options.get("writer", None if stream else "batch")
        if not self.writer or not re.fullmatch(r"[A-Za-z0-9_-]+", self.writer):
            raise ValueError("option 'writer' names the log of a stream: letters, digits, _ and -")
        self.folder = f"{'stream' if stream else 'batch'}-{self.writer}"
        self.rows_per_file = int(options.get("rows_per_file", ROWS_PER_FILE))
        self.fold_every = int(options.get("fold_every", FOLD_EVERY))


class BatchWriter(DS.DataSourceArrowWriter):
    def __init__(self, settings: _Settings):
        self.settings = settings
        # made once in the driver: all files of the write begin with it
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _Task(self.settings.path, self.settings.rows_per_file, self.job).run(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        log, files = Log(self.settings.path, self.settings.folder), _files(messages)
        if files:
            log.commit(log.next(), files, self.settings.fold_every)

    def abort(self, messages: list[Written | None]) -> None:
        # those of tasks that were killed, too, which have sent no message
        fs, root = _open(self.settings.path)
        found = fs.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True))
        _delete(self.settings.path, [f.base_name for f in found if f.base_name.startswith(self.job)])


class StreamWriter(DS.DataSourceStreamArrowWriter):
    def __init__(self, settings: _Settings):
        self.settings = settings

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _Task(self.settings.path, self.settings.rows_per_file).run(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        log, files = Log(self.settings.path, self.settings.folder), _files(messages)
        if log.holds(batchId):
            # the batch has been committed before: its points are there
            _delete(self.settings.path, [f.name for f in files])
        else:
            log.commit(batchId, files, self.settings.fold_every)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        _delete(self.settings.path, [f.name for f in _files(messages)])


# --- reading ---------------------------------------------------------------


@dataclass
class Files(DS.InputPartition):
    """Files that one task reads, one after the other."""

    names: list[str]
    bounds: Bounds


def _packed(files: Iterable[File], bounds: Bounds, rows: int) -> list[Files]:
    """Partitions of about so many rows: small files of a stream share one."""
    parts: list[Files] = []
    held = rows
    for f in files:
        if held >= rows:
            parts.append(Files([], bounds))
            held = 0
        parts[-1].names.append(f.name)
        held += f.rows
    return parts


def _batches(path: str, part: Files) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    fs, root = _open(path)
    schema = to_arrow_schema(POINT_SCHEMA)
    for name in part.names:
        found = ds.dataset(f"{root}/data/{name}", filesystem=fs, format="parquet")
        for batch in found.to_batches(filter=part.bounds.expression(), batch_size=BATCH_ROWS):
            if batch.num_rows:
                yield from pa.Table.from_batches([batch]).cast(schema).to_batches()


def _micros(value: datetime) -> int:
    moment = value if value.tzinfo is not None else value.replace(tzinfo=timezone.utc)
    gone = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (gone.days * 86_400 + gone.seconds) * 1_000_000 + gone.microseconds


class Reader(DS.DataSourceReader):
    """Whole commits of all writers, without the files that the filters rule out."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.rows = int(options.get("rows_per_partition", ROWS_PER_PARTITION))
        self.bounds = Bounds()

    def pushFilters(self, filters: list[DS.Filter]) -> Iterable[DS.Filter]:
        """Narrow the bounds. All filters go back to Spark, which applies them to the rows that are left."""
        b = self.bounds
        for f in filters:
            if getattr(f, "attribute", None) == ("measurement",) and isinstance(f, (DS.EqualTo, DS.EqualNullSafe)):
                b.measurement = f.value if f.value is not None else b.measurement
            elif getattr(f, "attribute", None) == ("time",) and isinstance(getattr(f, "value", None), datetime):
                at = _micros(f.value)
                if isinstance(f, (DS.GreaterThan, DS.GreaterThanOrEqual, DS.EqualTo)):
                    b.first = at if b.first is None else max(b.first, at)
                if isinstance(f, (DS.LessThan, DS.LessThanOrEqual, DS.EqualTo)):
                    b.last = at if b.last is None else min(b.last, at)
            yield f

    def partitions(self) -> Sequence[Files]:
        files = [f for w in _writers(self.path) for _, f in Log(self.path, w).entries() if self.bounds.may_hold(f)]
        return _packed(files, self.bounds, self.rows) or [Files([], self.bounds)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition)


class StreamReader(DS.DataSourceStreamReader):
    """Commits in the order of each writer; an offset holds the next commit of every one."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.rows = int(options.get("rows_per_partition", ROWS_PER_PARTITION))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {w: Log(self.path, w).next() for w in _writers(self.path)}

    def partitions(self, start: dict, end: dict) -> Sequence[Files]:
        found = [Log(self.path, w).entries(start.get(w, 0), last) for w, last in sorted(end.items())]
        return _packed([f for entries in found for _, f in entries], Bounds(), self.rows)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition)


class PointSource(DS.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return POINT_SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        _check(schema, overwrite)
        return BatchWriter(_Settings(dict(self.options), stream=False))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        _check(schema, overwrite)
        return StreamWriter(_Settings(dict(self.options), stream=True))


def _check(schema: StructType, overwrite: bool) -> None:
    if overwrite:
        raise ValueError("points are appended: use mode 'append'")
    missing = set(POINT_SCHEMA.names) - set(schema.names)
    if missing:
        raise ValueError(f"these are no points: {sorted(missing)} missing")
