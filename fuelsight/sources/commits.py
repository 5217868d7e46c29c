"""Tables that change together, by one commit.

A store is a folder of Parquet parts and a numbered list of manifests.  A manifest names, for each table, the parts that it
consists of; readers take the newest one.  A run writes its parts to a folder of its own, unseen, and then creates the next manifest in one
step that fails if another run was faster.  So facts and marks become visible together or not at all: what breaks off leaves
only files that no manifest names, and its repetition starts from the state it started from.

A part has a key: appended parts a new one, replaced ones the value of a column (a day), merged
ones the hash bucket of their rows' keys.  A merge rewrites the buckets that have updates; the others keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class ConcurrentCommit(RuntimeError):
    """Another run has committed since this one began."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self._conf)

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifest")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of a version."""
        known = self.versions()
        if not known:
            return {"version": 0, "tables": {}}
        with_name = self._path(f"{self.root}/_manifest/{known[-1] if version is None else version:020d}.json")
        stream = self.fs.open(with_name)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, table: str, parts: list[str] | None = None, version: int | None = None, manifest: dict | None = None) -> DataFrame | None:
        """The rows of a table, or of some of its parts; None where the table has never been written."""
        found = (manifest or self.manifest(version))["tables"].get(table)
        if found is None:
            return None
        schema = StructType.fromJson(found["schema"])
        paths = [f"{self.root}/{p}" for k, p in found["parts"].items() if parts is None or k in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def begin(self) -> "Transaction":
        return Transaction(self, self.manifest())

    def put_new(self, name: str, text: str) -> None:
        """Creates a file that must not be there yet, whole or not at all."""
        jvm = self.spark.sparkContext._jvm
        target = self._path(f"{self.root}/{name}")
        new = self._path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
        out = self.fs.create(new, True)
        out.write(text.encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else self.fs.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(new, target, options)
        except Exception as e:
            self.fs.delete(new, False)
            if self.fs.exists(target):
                raise ConcurrentCommit(f"{target.toString()} is there already") from e
            raise

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes run folders that none of the last ``keep`` manifests names (of runs that broke off too, so run it alone)."""
        live = {p.split("/")[1] for v in self.versions()[-keep:] for t in self.manifest(v)["tables"].values() for p in t["parts"].values()}
        folder = self._path(f"{self.root}/data")
        gone = [s.getPath().getName() for s in self.fs.listStatus(folder) if s.getPath().getName() not in live] if self.fs.exists(folder) else []
        for name in gone:
            self.fs.delete(self._path(f"{self.root}/data/{name}"), True)
        return gone


class Transaction:
    """Writes of one run; nothing is seen before :meth:`commit`."""

    def __init__(self, store: Store, base: dict):
        self.store, self.base = store, base
        self.run = uuid.uuid4().hex
        self.tables = {name: {"schema": t["schema"], "parts": dict(t["parts"])} for name, t in base["tables"].items()}

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame | None:
        """As it was when the run began."""
        return self.store.read(table, parts, manifest=self.base)

    def _entry(self, table: str, df: DataFrame) -> dict:
        return self.tables.setdefault(table, {"schema": df.schema.jsonValue(), "parts": {}})

    def append(self, table: str, df: DataFrame) -> None:
        """Adds rows as a new part."""
        path = f"data/{self.run}/{table}-{len(self._entry(table, df)['parts'])}"
        df.write.parquet(f"{self.store.root}/{path}")
        self.tables[table]["parts"][f"{self.run}-{path}"] = path

    def _write_keyed(self, table: str, df: DataFrame, key) -> dict[str, str]:
        """Writes ``df`` in one folder per value of ``key``; the folders by value."""
        path = f"data/{self.run}/{table}"
        keyed = df.withColumn("_part", key.cast("string"))
        keyed.hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{self.store.root}/{path}")
        folder = self.store._path(f"{self.store.root}/{path}")
        names = [s.getPath().getName() for s in self.store.fs.listStatus(folder)]
        return {n.removeprefix("_part="): f"{path}/{n}" for n in names if n.startswith("_part=")}

    def replace(self, table: str, df: DataFrame, by: str, parts: list[str] | None = None) -> None:
        """Replaces the parts of the values that ``df`` has in ``by`` (and those named, which may have no rows any more)."""
        entry = self._entry(table, df)
        for p in parts or []:
            entry["parts"].pop(p, None)
        entry["parts"].update(self._write_keyed(table, df, F.col(by)))

    def merge(self, table: str, updates: DataFrame, keys: tuple[str, ...], combine: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
        """``combine`` gets the old rows of the touched buckets with the updates, and returns the new rows."""
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        touched = [str(r[0]) for r in updates.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        old = self.read(table, touched)
        rows = combine(updates if old is None else old.unionByName(updates))
        entry = self._entry(table, rows)
        for b in touched:
            entry["parts"].pop(b, None)
        entry["parts"].update(self._write_keyed(table, rows, bucket))

    def upsert(self, table: str, updates: DataFrame, keys: tuple[str, ...], version: str, buckets: int = BUCKETS) -> None:
        """The newest version of each key stays (of equal versions the largest row)."""
        rest = [c for c in updates.columns if c not in keys]
        order = F.struct(version, *[c for c in rest if c != version])

        def newest(rows: DataFrame) -> DataFrame:
            kept = rows.groupBy(*keys).agg(F.max(order).alias("_row"))
            return kept.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*updates.columns)

        self.merge(table, updates, keys, newest, buckets)

    def commit(self) -> int:
        version = self.base["version"] + 1
        self.store.put_new(f"_manifest/{version:020d}.json", json.dumps({"version": version, "run": self.run, "tables": self.tables}))
        return version

    def abort(self) -> None:
        self.store.fs.delete(self.store._path(f"{self.store.root}/data/{self.run}"), True)
