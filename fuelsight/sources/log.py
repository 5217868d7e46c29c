"""A partitioned log in files, read as a stream with its own offsets.

Where no broker runs, uploads are kept as segment files of a log: ``partition=<p>/<first>-<last>.parquet``, where the
name tells the offsets of the rows (``key``, ``value``) in it.  It is a Python data source, so Spark
plans, schedules and retries the reads:

- ``spark.readStream.format("segment_log")`` reads ``partition, offset, key, value``.  A micro-batch takes at most
  ``max_per_partition`` records of each partition (the rate cap), a task one segment's share of it.
- With a ``group``, offsets that Spark has done with are stored beside the log; a query without a checkpoint of its own goes on
  from there (at least once, as the last batch is only known to be done when the next begins).  A checkpoint, where
  there is one, rules, and then every record counts once.
- Segments may age out.  A start that lies before the earliest segment left is moved up to it, and the range that was
  missed is stored (:func:`skipped`); with ``fail_on_data_loss`` it is an error instead.
- ``df.write.format("segment_log")`` appends ``partition, key, value``: tasks write files without knowing their offsets, and
  the commit names them one after the other, in the order of the tasks.  What an aborted job has written is removed.

Paths go through Arrow's file systems, so the folder may be in any store that all nodes reach.
"""

from __future__ import annotations

import ast
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

READ_SCHEMA = "partition int, offset long, key string, value string"
_FILE_SCHEMA = pa.schema([("key", pa.string()), ("value", pa.string())])
SEGMENT_ROWS = 1 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Segment:
    """Records ``first`` to ``last`` of a partition."""

    partition: int
    first: int
    last: int
    path: str


def segments(path: str) -> list[Segment]:
    """All segments of a log, by partition and offset (two levels of listing; no file is opened)."""
    fs, root = file_system(path)
    found = []
    for folder in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if folder.type == pafs.FileType.Directory and folder.base_name.startswith("partition="):
            p = int(folder.base_name.split("=")[1])
            for f in fs.get_file_info(pafs.FileSelector(folder.path)):
                if f.base_name.endswith(".parquet") and not f.base_name.startswith("."):
                    first, last = f.base_name.removesuffix(".parquet").split("-")
                    found.append(Segment(p, int(first), int(last), f.path))
    return sorted(found, key=lambda s: (s.partition, s.first))


def ends(path: str) -> dict[int, int]:
    """The next offset that each partition will give."""
    return {s.partition: s.last + 1 for s in segments(path)}


def drain(query, path: str) -> None:
    """Waits until a running query has taken all that the log holds now (``processAllAvailable`` waits for one capped batch only)."""
    goal = ends(path)
    while query.isActive:
        query.processAllAvailable()
        progress = query.lastProgress
        done = ast.literal_eval(str(progress["sources"][0]["endOffset"])) if progress else {}
        if all((done or {}).get(str(p), 0) >= o for p, o in goal.items()):
            return
        time.sleep(0.05)
    if query.exception() is not None:
        raise query.exception()


def _read_json(path: str, name: str) -> dict | None:
    fs, root = file_system(path)
    if fs.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{root}/{name}") as f:
        return json.loads(f.read())


def _write_json(path: str, name: str, value) -> None:
    """Replaces a small file in one step, so a reader sees the old or the new one."""
    fs, root = file_system(path)
    fs.create_dir(f"{root}/_groups", recursive=True)
    new = f"{root}/{name}.{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(new) as f:
        f.write(json.dumps(value).encode())
    fs.move(new, f"{root}/{name}")


def stored_offsets(path: str, group: str) -> dict[int, int]:
    """The next offset of each partition that the group has not done yet."""
    return {int(p): o for p, o in (_read_json(path, f"_groups/{group}.json") or {}).items()}


def skipped(path: str, group: str) -> list[dict]:
    """Ranges (``partition``, ``first``, ``last``) that the group missed because their segments had aged out."""
    return (_read_json(path, f"_groups/{group}.skipped.json") or {"ranges": []})["ranges"]


@dataclass
class _Slice(InputPartition):
    """Records ``first`` to ``last`` of one segment."""

    segment: Segment
    first: int
    last: int


class LogReader(DataSourceStreamReader):
    """Offsets are dicts ``{partition: next offset}``."""

    def __init__(self, path: str, group: str | None, cap: int | None, fail: bool):
        self.path, self.group, self.cap, self.fail = path, group, cap, fail
        self.planned: dict[str, int] | None = None

    def _bounds(self) -> tuple[dict[str, int], dict[str, int]]:
        low, high = {}, {}
        for s in segments(self.path):
            low.setdefault(str(s.partition), s.first)
            high[str(s.partition)] = s.last + 1
        return low, high

    def _clamp(self, start: dict, low: dict) -> dict:
        """``start`` moved up to the earliest records left; what is missed is stored."""
        missed = [{"partition": int(p), "first": o, "last": low[p] - 1} for p, o in start.items() if p in low and o < low[p]]
        if missed and self.fail:
            raise ValueError(f"records of {self.path} have aged out before they were read: {missed}")
        if missed and self.group:
            known = skipped(self.path, self.group)
            _write_json(self.path, f"_groups/{self.group}.skipped.json", {"ranges": known + [m for m in missed if m not in known]})
        return {p: max(o, low.get(p, o)) for p, o in start.items()}

    def initialOffset(self) -> dict:
        low, _ = self._bounds()
        stored = stored_offsets(self.path, self.group) if self.group else {}
        self.planned = self._clamp({p: stored.get(int(p), o) for p, o in low.items()}, low)
        return self.planned

    def latestOffset(self) -> dict:
        """At most ``cap`` records a partition beyond what was planned last; the plan is kept beside the log, so a restart goes on from it."""
        low, high = self._bounds()
        if self.cap is None:
            return high
        plan = f"_groups/{self.group or 'reader'}.planned.json"
        start = self.planned or _read_json(self.path, plan) or low
        start = {p: max(start.get(p, o), o) for p, o in low.items()}
        self.planned = {p: min(high[p], o + self.cap) for p, o in start.items()}
        _write_json(self.path, plan, self.planned)
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, _ = self._bounds()
        start = self._clamp({p: start.get(p, low.get(p, 0)) for p in end}, low)
        return [_Slice(s, max(s.first, start[str(s.partition)]), min(s.last, end[str(s.partition)] - 1)) for s in segments(self.path)
                if str(s.partition) in end and s.last >= start[str(s.partition)] and s.first < end[str(s.partition)]]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(self.path)
        at = partition.segment.first
        with fs.open_input_file(partition.segment.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=10_000, columns=["key", "value"]):
                lo, hi = max(at, partition.first), min(at + len(batch), partition.last + 1)
                if hi > lo:
                    part = batch.slice(lo - at, hi - lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([partition.segment.partition] * len(part), pa.int32()), pa.array(range(lo, hi), pa.int64()), *part.columns],
                        names=["partition", "offset", "key", "value"])
                at += len(batch)

    def commit(self, end: dict) -> None:
        if self.group:
            _write_json(self.path, f"_groups/{self.group}.json", end)


@dataclass
class _Written(WriterCommitMessage):
    """New files of one task: (partition, rows, path)."""

    files: list[tuple[int, int, str]]


class LogWriter(DataSourceArrowWriter):
    def __init__(self, path: str, segment_rows: int):
        self.path, self.segment_rows, self.job = path, segment_rows, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, root = file_system(self.path)
        done: list[tuple[int, int, str]] = []
        open_files: dict[int, list] = {}  # partition -> [writer, rows, path]

        def close(p: int) -> None:
            writer, rows, path = open_files.pop(p)
            writer.close()
            done.append((p, rows, path))

        for batch in iterator:
            for p in batch.column("partition").unique().to_pylist():
                rows = pa.Table.from_batches([batch]).filter(pa.compute.equal(batch.column("partition"), p)).select(["key", "value"]).cast(_FILE_SCHEMA)
                while len(rows):
                    if p not in open_files:
                        fs.create_dir(f"{root}/partition={p}", recursive=True)
                        path = f"{root}/partition={p}/.{self.job}-{uuid.uuid4().hex}.parquet"
                        open_files[p] = [pq.ParquetWriter(path, _FILE_SCHEMA, filesystem=fs), 0, path]
                    one = open_files[p]
                    head = rows.slice(0, self.segment_rows - one[1])
                    one[0].write_table(head)
                    one[1] += len(head)
                    rows = rows.slice(len(head))
                    if one[1] == self.segment_rows:
                        close(p)
        for p in list(open_files):
            close(p)
        return _Written(done)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root = file_system(self.path)
        following = ends(self.path)
        for m in messages:
            for p, rows, path in m.files if m else []:
                first = following.get(p, 0)
                following[p] = first + rows
                fs.move(path, f"{root}/partition={p}/{first:020d}-{first + rows - 1:020d}.parquet")

    def abort(self, messages: list[_Written | None]) -> None:
        """Removes the job's files, those of tasks that have failed included."""
        fs, root = file_system(self.path)
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f.base_name.startswith(f".{self.job}-"):
                fs.delete_file(f.path)


class SegmentLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segment_log"

    def schema(self) -> str:
        return READ_SCHEMA

    def streamReader(self, schema) -> LogReader:
        cap = self.options.get("max_per_partition")
        return LogReader(self.options["path"], self.options.get("group"), int(cap) if cap else None,
                         self.options.get("fail_on_data_loss", "false").lower() == "true")

    def writer(self, schema, overwrite: bool) -> LogWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        return LogWriter(self.options["path"], int(self.options.get("segment_rows", SEGMENT_ROWS)))


def append_log(df: DataFrame, path: str, partition: Column, key: Column, value: Column, order_by: tuple[str, ...],
               segment_rows: int = SEGMENT_ROWS) -> None:
    """Appends the rows of ``df``, those of one partition in order; a partition is one task's, as in any log."""
    df.sparkSession.dataSource.register(SegmentLog)
    rows = df.select(partition.cast("int").alias("partition"), key.cast("string").alias("key"), value.cast("string").alias("value"), *order_by)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(n, "partition").sortWithinPartitions("partition", *order_by).select("partition", "key", "value")
     .write.format("segment_log").option("path", path).option("segment_rows", segment_rows).mode("append").save())


def read_log(spark: SparkSession, path: str, group: str | None = None, max_per_partition: int | None = None,
             fail_on_data_loss: bool = False) -> DataFrame:
    """The log as a stream; start it with a processing-time trigger, as each trigger takes one capped batch."""
    spark.dataSource.register(SegmentLog)
    reader = spark.readStream.format("segment_log").option("path", path).option("fail_on_data_loss", str(fail_on_data_loss))
    if group:
        reader = reader.option("group", group)
    if max_per_partition:
        reader = reader.option("max_per_partition", max_per_partition)
    return reader.load()
