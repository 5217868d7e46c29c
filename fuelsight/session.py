"""Session helpers: a local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "fuelsight") -> SparkSession:
    """Local session used by tests and the bench (no UI, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the context's checkpoint folder.

    Spark takes it from ``spark.checkpoint.dir``, or the application names it
    with ``setCheckpointDir``; staged tables and ``checkpoint()`` then share one
    place.  Only on a local master (tests) is a fresh scratch folder chosen
    where neither is given; elsewhere that would be a different disk for each
    executor, so it is an error.
    """
    sc = spark.sparkContext
    own = sc._jsc.sc().getCheckpointDir()
    if not own.isEmpty():
        return own.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("no shared folder: set spark.checkpoint.dir (or call setCheckpointDir)")
        path = tempfile.mkdtemp(prefix="fuelsight-ckpt-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop's FileSystem (works for any shared store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table that is no longer needed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stream_conf(executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Like :func:`cluster_conf` for the streaming detectors.

    Every shuffle partition of a stateful query is a state store that each
    micro-batch opens and commits, so there are a fraction of a store per core,
    not three partitions.
    """
    return {**cluster_conf(executors, cores_per_executor), **stateful_conf(),
            "spark.sql.shuffle.partitions": str(max(8, executors * cores_per_executor // 8))}


def stateful_conf() -> dict[str, str]:
    """What the detectors with timers need: a state store that holds several states per vehicle, and keeps them off the heap."""
    return {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def cluster_conf(executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings we recommend for the 100 TB runs (pass to ``SparkSession.builder.config``).

    * shuffle partitions start at ~3 per core; AQE coalesces small ones to
      ~256 MB and splits skewed ones (a hot vehicle) in joins;
    * scan splits of 256 MB keep the number of map tasks in the tens of
      thousands for 100 TB of Parquet;
    * runtime broadcast only below 64 MB of *measured* shuffle output — no
      static hint anywhere in the library depends on data size;
    * Arrow batches of 10k rows bound the Python side of the refuel detector.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.parquet.filterPushdown": "true",
    }
