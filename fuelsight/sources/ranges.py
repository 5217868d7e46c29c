"""A versioned table kept in key order, scanned by key range.

Rows are keyed by vehicle and time and carry a version.  Each load is written as a *run*: files that are sorted by
(vehicle, time, version) and do not overlap, in row groups of ``rows_per_block``, and a directory with the first and
last key of each file.  The directory is written last, so a run that broke off is not seen.

A read is a Python data source.  It plans its tasks from the directories: the key ranges of the run with the most
files that meet the wanted range.  A task opens the footers of the files that meet its range, in every run, reads only the
row groups whose statistics do, and merges them in key order to the newest version of each key.  So there is no shuffle, and a
vehicle with a third of all rows is split by time.  Bounds come as options or as pushed filters
(``spark.sql.python.filterPushdown.enabled``) on the two key columns.
"""

from __future__ import annotations

import bisect
import datetime as dt
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .log import file_system

ROWS_PER_FILE = 4 << 20
ROWS_PER_BLOCK = 64 << 10
_BATCH = 10_000
_DIRECTORY = "_directory.json"
_EPOCH = dt.datetime(1970, 1, 1)

#: A key is (vehicle, microseconds); the range of all keys.
_LOWEST, _HIGHEST = ("", -(1 << 62)), ("\U0010ffff", 1 << 62)


def _micros(ts: dt.datetime) -> int:
    return (ts - _EPOCH) // dt.timedelta(microseconds=1)


def write_run(df: DataFrame, path: str, key: str = "vin", ts_col: str = "ts", version_col: str = "version",
              rows_per_file: int = ROWS_PER_FILE, rows_per_block: int = ROWS_PER_BLOCK) -> str:
    """Adds the rows of ``df`` as one run; a row without a vehicle or a time has no place in key order and is an error."""
    rows, lacking = df.agg(F.count("*"), F.count(F.when(F.col(key).isNull() | F.col(ts_col).isNull(), 1))).first()
    if lacking:
        raise ValueError(f"{lacking} rows have no key ({key}, {ts_col})")
    run = f"run={uuid.uuid4().hex}"
    target = f"{path}/{run}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(target)
        writer = held = first = last = None
        name, n = f"{uuid.uuid4().hex}.parquet", 0
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                fs.create_dir(root, recursive=True)
                writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=fs, compression="zstd", write_page_index=True)
                first = (batch.column(key)[0].as_py(), batch.column(ts_col)[0].as_py())
            last = (batch.column(key)[-1].as_py(), batch.column(ts_col)[-1].as_py())
            n += len(batch)
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while len(held) >= rows_per_block:  # a row group is one block
                writer.write_table(held.slice(0, rows_per_block))
                held = held.slice(rows_per_block)
        if writer is not None:
            if len(held):
                writer.write_table(held)
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "rows": n, "first_key": first[0], "first_us": _micros(first[1]),
                                               "last_key": last[0], "last_us": _micros(last[1])}])

    n_files = max(1, -(-rows // rows_per_file))
    ordered = df.repartitionByRange(n_files, key, ts_col).sortWithinPartitions(key, ts_col, version_col)
    report = ordered.mapInArrow(write, "file string, rows long, first_key string, first_us long, last_key string, last_us long").collect()  # a row per file
    fs, root = file_system(target)
    fs.create_dir(root, recursive=True)
    files = sorted((r.asDict() for r in report), key=lambda r: (r["first_key"], r["first_us"]))
    content = {"schema": df.schema.jsonValue(), "key": key, "ts": ts_col, "version": version_col, "files": files}
    with fs.open_output_stream(f"{root}/.{_DIRECTORY}") as f:
        f.write(json.dumps(content).encode())
    fs.move(f"{root}/.{_DIRECTORY}", f"{root}/{_DIRECTORY}")
    return run


def directories(path: str) -> list[dict]:
    """The directories of all finished runs; files with their full path."""
    fs, root = file_system(path)
    found = []
    for folder in sorted(fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)), key=lambda f: f.path):
        name = f"{folder.path}/{_DIRECTORY}"
        if folder.base_name.startswith("run=") and fs.get_file_info(name).type == pafs.FileType.File:
            with fs.open_input_stream(name) as f:
                one = json.loads(f.read())
            for r in one["files"]:
                r["file"] = f"{folder.path}/{r['file']}"
            found.append(one)
    return found


def _meeting(files: list[dict], low: tuple, high: tuple) -> list[dict]:
    """The files of one run that may hold keys of ``[low, high)``: they are in key order, so two binary searches."""
    start = bisect.bisect_left(files, low, key=lambda r: (r["last_key"], r["last_us"]))
    stop = bisect.bisect_left(files, high, key=lambda r: (r["first_key"], r["first_us"]))
    return files[start:stop]


@dataclass
class KeyRange(InputPartition):
    """Keys from ``low`` to before ``high``, and the files of all runs that may hold some."""

    low: tuple[str, int]
    high: tuple[str, int]
    files: list[str]


def plan(path: str, bounds: list[tuple[tuple, tuple]]) -> list[KeyRange]:
    """Tasks for some disjoint key ranges."""
    runs = [d["files"] for d in directories(path) if d["files"]]
    out = []
    for low, high in bounds:
        met = [_meeting(files, low, high) for files in runs]
        if not any(met):
            continue
        edges = sorted({max(low, (r["first_key"], r["first_us"])) for r in max(met, key=len)})
        edges = [low, *edges[1:], high]
        for a, b in zip(edges, edges[1:]):
            files = [r["file"] for m in met for r in _meeting(m, a, b)]
            if files:
                out.append(KeyRange(a, b, files))
    return out


def blocks(task: KeyRange, path: str, key: str, ts_col: str) -> list[tuple[str, list[int], int]]:
    """The row groups of each file that may hold keys of the range, by their statistics, and how many the file has."""
    fs, _ = file_system(path)
    out = []
    for file in task.files:
        meta = pq.read_metadata(file, filesystem=fs)
        at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        picked = []
        for g in range(meta.num_row_groups):
            k, t = (meta.row_group(g).column(at[c]).statistics for c in (key, ts_col))
            if k.min > task.high[0] or k.max < task.low[0]:
                continue
            if k.min == k.max:  # one vehicle: its times tell
                if (k.min, _micros(t.min)) >= task.high or (k.max, _micros(t.max)) < task.low:
                    continue
            picked.append(g)
        out.append((file, picked, meta.num_row_groups))
    return out


class RangeReader(DataSourceReader):
    def __init__(self, path: str, options: dict[str, str]):
        self.path = path
        found = directories(path)
        if not found:
            raise ValueError(f"{path} has no finished run")
        self.key, self.ts, self.version = (found[0][c] for c in ("key", "ts", "version"))
        self.latest = options.get("latest", "true").lower() == "true"
        self.keys = json.loads(options["keys"]) if "keys" in options else None
        self.key_from, self.key_to = options.get("key_from"), options.get("key_to")
        self.start, self.end = (_micros(dt.datetime.fromisoformat(options[c])) if c in options else None for c in ("start", "end"))

    def bounds(self) -> list[tuple[tuple, tuple]]:
        """The wanted key ranges: one per named vehicle (its times), or one from vehicle to vehicle."""
        if self.keys is not None:
            lo = self.start if self.start is not None else _LOWEST[1]
            hi = self.end if self.end is not None else _HIGHEST[1]
            return [((k, lo), (k, hi)) for k in sorted(set(self.keys))]
        return [((self.key_from, _LOWEST[1]) if self.key_from is not None else _LOWEST, (self.key_to, _LOWEST[1]) if self.key_to is not None else _HIGHEST)]

    def partitions(self) -> list[KeyRange]:
        return plan(self.path, self.bounds())

    def read(self, partition: KeyRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's stand-in where nothing is planned
            return
        fs, _ = file_system(self.path)
        parts = []
        for file, groups, _ in blocks(partition, self.path, self.key, self.ts):
            if groups:
                with fs.open_input_file(file) as f:
                    parts += [self._wanted(pq.ParquetFile(f).read_row_group(g), partition) for g in groups]
        if not parts:
            return
        rows = pa.concat_tables(parts)
        rows = rows.sort_by([(self.key, "ascending"), (self.ts, "ascending"), (self.version, "descending")]).combine_chunks()
        if self.latest and len(rows):
            # a row is its key's newest where the row before has another key
            other = np.zeros(len(rows), bool)
            other[0] = True
            for c in (self.key, self.ts):
                column = rows.column(c)
                other[1:] |= pa.compute.not_equal(column.slice(1), column.slice(0, len(rows) - 1)).to_numpy()
            rows = rows.filter(pa.array(other))
        yield from rows.to_batches(max_chunksize=_BATCH)

    def _wanted(self, rows: pa.Table, task: KeyRange) -> pa.Table:
        """The rows of a block whose keys are in the task's range and the wanted times."""
        c = pa.compute
        k, t = rows.column(self.key), rows.column(self.ts).cast(pa.int64())
        (lk, lt), (hk, ht) = task.low, task.high
        keep = c.and_(c.or_(c.greater(k, lk), c.and_(c.equal(k, lk), c.greater_equal(t, lt))),
                      c.or_(c.less(k, hk), c.and_(c.equal(k, hk), c.less(t, ht))))
        if self.start is not None:
            keep = c.and_(keep, c.greater_equal(t, self.start))
        if self.end is not None:
            keep = c.and_(keep, c.less(t, self.end))
        return rows.filter(keep)


class PushingReader(RangeReader):
    """Spark takes a reader with this method only while filter pushdown to Python sources is on."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds on the key columns narrow the range.  Spark applies all of them again, as blocks hold other keys too."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column == self.key and isinstance(f, EqualTo):
                self.keys = [f.value] if self.keys is None else [k for k in self.keys if k == f.value]
            elif column == self.ts and isinstance(getattr(f, "value", None), dt.datetime):
                us = _micros(f.value.replace(tzinfo=None))
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.start = us if self.start is None else max(self.start, us)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.end = us + 1 if self.end is None else min(self.end, us + 1)
            yield f


class KeyRangeTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "key_range"

    def schema(self) -> StructType:
        found = directories(self.options["path"])
        if not found:
            raise ValueError(f"{self.options['path']} has no finished run")
        return StructType.fromJson(found[0]["schema"])

    def reader(self, schema: StructType) -> RangeReader:
        kind = PushingReader if self.options.get("push", "false").lower() == "true" else RangeReader
        return kind(self.options["path"], dict(self.options))


def read_runs(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, keys: list[str] | None = None,
              key_from: str | None = None, key_to: str | None = None, latest: bool = True) -> DataFrame:
    """Rows with ``start <= time < end`` of the named vehicles, or of those from ``key_from`` to before ``key_to``; newest versions only, if ``latest``."""
    spark.dataSource.register(KeyRangeTable)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("key_range").option("path", path).option("latest", str(latest)).option("push", push)
    for name, value in (("start", start), ("end", end), ("key_from", key_from), ("key_to", key_to), ("keys", json.dumps(keys) if keys is not None else None)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()
