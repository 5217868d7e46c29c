"""The lookup table: even, stable under change, and the same as a plain reading of the rule."""

import hashlib
from collections import Counter

import duckdb
import pytest

from fuelsight.llm import sharding as H


def plain(shards, slots):
    """Each shard's whole permutation, claimed in turns."""
    perms = []
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        a, b = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        perms.append(iter([(a + j * b) % slots for j in range(slots)]))
    out = {}
    while len(out) < slots:
        for k, p in enumerate(perms):
            if len(out) < slots:
                out[next(x for x in p if x not in out)] = k
    return [out[i] for i in range(slots)]


@pytest.mark.parametrize("n,slots", [(1, 2), (3, 7), (5, 101), (40, 997), (7, 7)])
def test_table_follows_the_rule(n, slots):
    shards = [f"s{i}" for i in range(n)]
    assert H.lookup_table(shards, slots) == plain(shards, slots)


def test_even_and_few_keys_move():
    full = H.lookup_table(list(H.SHARDS))
    n = Counter(full)
    assert max(n.values()) - min(n.values()) <= 1 and len(n) == 256
    less = H.lookup_table([s for s in H.SHARDS if s != "shard-100"])
    names = [s for s in H.SHARDS if s != "shard-100"]
    moved = sum(H.SHARDS[a] != "shard-100" and H.SHARDS[a] != names[b] for a, b in zip(full, less))
    assert moved < 0.05 * len(full)


def test_rejects_bad_tables():
    for shards, slots in (([], 7), (["a"], 8), (["a", "a"], 7), (list("abc"), 2)):
        with pytest.raises(ValueError):
            H.lookup_table(shards, slots)


def test_null_repeated_empty_and_clash(spark):
    d = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "d")], "doc_id long, slot string")
    rows = H.place(d, "doc_id").collect()
    assert rows[0].shard == rows[1].shard is not None and rows[2].shard == rows[3].shard
    assert H.place(d.limit(0), "doc_id").count() == 0
    with pytest.raises(ValueError):
        H.place(d.withColumnRenamed("slot", "shard"), "doc_id")


def test_query_equals_duckdb_and_is_native(spark):
    sf = "/root/testdata/sf0.01"
    df = H.op5_sharding(spark, sf)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(H.oracle()).fetchall())
    plan = df._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_write_sharded(spark, tmp_path):
    d = spark.range(500).withColumnRenamed("id", "doc_id")
    H.write_sharded(d, f"{tmp_path}/out", "doc_id", shards=["a", "b", "c"], slots=101)
    back = spark.read.parquet(f"{tmp_path}/out")
    want = H.place(d, "doc_id", ["a", "b", "c"], 101)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))
