"""The log source: offsets, cap, resume, segments that have aged out."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fuelsight.sources import log as L


def fill(spark, path, n, start=0, segment_rows=10):
    """``n`` records, dealt to two partitions in turn."""
    df = spark.range(start, start + n)
    L.append_log(df, path, F.col("id") % 2, F.concat(F.lit("k"), F.col("id")), F.col("id"), ("id",), segment_rows)


def run(spark, path, checkpoint=None, batches=None, **options):
    """Rows of a run until nothing is left (or so many batches), and the sizes of its batches."""
    out, sizes = tempfile.mkdtemp(prefix="log-out-"), []

    def write(batch, epoch):
        rows = batch.persist()
        sizes.append(rows.groupBy("partition").count().count() and rows.groupBy("partition").count().agg(F.max("count")).first()[0])
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        rows.unpersist()
        if batches is not None and len(sizes) > batches:
            raise RuntimeError("stopped by the test")

    q = (L.read_log(spark, path, **options).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or tempfile.mkdtemp())
         .trigger(processingTime="0 seconds").start())
    try:
        L.drain(q, path)
    except Exception:
        assert batches is not None
    q.stop()
    found = [d for d in os.listdir(out) if d.startswith("epoch=")]
    rows = spark.read.schema(L.READ_SCHEMA).parquet(*[f"{out}/{d}" for d in found]).collect() if found else []
    return sorted((r.partition, r.offset, r.key, int(r.value)) for r in rows), sizes


def expected(lo, hi):
    return sorted((i % 2, i // 2, f"k{i}", i) for i in range(lo, hi))


def test_offsets_follow_the_order_and_the_cap_holds(spark):
    path = tempfile.mkdtemp(prefix="log-") + "/a"
    fill(spark, path, 57)
    fill(spark, path, 20, start=57)  # partition 1 goes on first, as 57 is odd: offsets stay gapless
    rows, sizes = run(spark, path, max_per_partition=8)
    assert rows == expected(0, 77) and max(sizes) == 8 and len(sizes) >= 5
    assert [(s.first, s.last) for s in L.segments(path) if s.partition == 0][:2] == [(0, 9), (10, 19)]
    assert run(spark, path)[0] == expected(0, 77)


def test_a_checkpoint_resumes_exactly_once(spark):
    path, checkpoint = tempfile.mkdtemp(prefix="log-") + "/a", tempfile.mkdtemp()
    fill(spark, path, 40)
    first, sizes = run(spark, path, checkpoint, max_per_partition=8, group="g")
    fill(spark, path, 30, start=40)
    second, more = run(spark, path, checkpoint, max_per_partition=8, group="g")
    assert first == expected(0, 40) and second == expected(40, 70) and max(sizes + more) == 8


def test_a_group_resumes_without_a_checkpoint(spark):
    path = tempfile.mkdtemp(prefix="log-") + "/a"
    fill(spark, path, 40)
    run(spark, path, max_per_partition=5, group="g")
    done = L.stored_offsets(path, "g")
    assert set(done) == {0, 1} and all(5 <= o < 20 for o in done.values())  # the last batch is not known to be done
    rows, _ = run(spark, path, group="g")
    assert rows == [r for r in expected(0, 40) if r[1] >= done[r[0]]]
    assert L.skipped(path, "g") == []


def test_a_failed_run_goes_on_where_it_stopped(spark):
    path, checkpoint = tempfile.mkdtemp(prefix="log-") + "/a", tempfile.mkdtemp()
    fill(spark, path, 60)
    first, _ = run(spark, path, checkpoint, batches=2, max_per_partition=6, group="g")
    second, _ = run(spark, path, checkpoint, max_per_partition=6, group="g")
    assert sorted(set(first + second)) == expected(0, 60)
    assert len(first + second) - 60 <= 2 * 12  # only the batch that failed comes again


def test_aged_segments_are_clamped_and_reported(spark):
    path = tempfile.mkdtemp(prefix="log-") + "/a"
    fill(spark, path, 80)
    run(spark, path, max_per_partition=5, group="g", batches=2)
    done = L.stored_offsets(path, "g")
    assert done
    for s in L.segments(path):
        if s.partition == 0 and s.last < 30:
            os.remove(s.path)
    rows, _ = run(spark, path, group="g")
    assert rows == [r for r in expected(0, 80) if r[1] >= (30 if r[0] == 0 else done.get(1, 0))]
    assert L.skipped(path, "g") == [{"partition": 0, "first": done.get(0, 0), "last": 29}]
    q = (L.read_log(spark, path, group="h").writeStream.format("noop").option("checkpointLocation", tempfile.mkdtemp()).start())
    q.processAllAvailable()
    q.stop()
    assert L.skipped(path, "h") == []  # a new group begins with what there is


def test_aged_segments_can_be_an_error(spark):
    path = tempfile.mkdtemp(prefix="log-") + "/a"
    fill(spark, path, 60)
    L._write_json(path, "_groups/g.json", {"0": 3, "1": 3})
    os.remove(next(s.path for s in L.segments(path) if s.partition == 1))
    q = (L.read_log(spark, path, group="g", fail_on_data_loss=True).writeStream.format("noop").option("checkpointLocation", tempfile.mkdtemp()).start())
    with pytest.raises(Exception, match="aged out"):
        q.processAllAvailable()
    rows, _ = run(spark, path, group="g")
    assert min(r[1] for r in rows if r[0] == 1) == 10 and min(r[1] for r in rows if r[0] == 0) == 3
    assert L.skipped(path, "g") == [{"partition": 1, "first": 3, "last": 9}]


def test_an_aborted_append_leaves_nothing(spark):
    path = tempfile.mkdtemp(prefix="log-") + "/a"
    fill(spark, path, 10)
    before = L.segments(path)
    bad = spark.range(40).withColumn("v", F.when(F.col("id") == 39, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")))
    with pytest.raises(Exception, match="no"):
        L.append_log(bad, path, F.col("id") % 2, F.col("id"), F.col("v"), ("id",))
    assert L.segments(path) == before
    assert not [f for _, _, files in os.walk(path) for f in files if f.startswith(".") and not f.endswith(".crc")]
    L.append_log(spark.range(0), path, F.col("id") % 2, F.col("id"), F.col("id"), ("id",))
    assert L.segments(path) == before and run(spark, path)[0] == expected(0, 10)
    with pytest.raises(Exception, match="appended"):
        spark.range(1).selectExpr("0 partition", "'a' key", "'b' value").write.format("segment_log").option("path", path).mode("overwrite").save()
