"""Benchmark decontamination against a plain scan of every window."""

import hashlib
import random
import re

import pytest

from fuelsight.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    tests = []
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        tests += [(str(item) if item is not None else "null", tuple(w[i:i + n])) for i in range(len(w) - n + 1)] if w else []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for label, t in tests:
            for p in range(len(w) - len(t) + 1):
                if tuple(w[p:p + len(t)]) == t:
                    hit.update(range(p, p + len(t)))
                    found.add(label)
        ids = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def digest(df):
    import pyspark.sql.functions as F
    df = df.withColumn("sha", F.sha2(F.array_join("item_ids", ","), 256))
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "sha", "contaminated").collect()], key=str)


def make(rng, n):
    return " ".join(rng.choice(["a", "B", "c-d", "é", "7", "ZZ"]) for _ in range(n))


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_equals_brute_force(spark, block_bytes):
    rng = random.Random(3)
    items = [(i, make(rng, rng.randint(0, 40))) for i in range(25)] + [(3, "a b"), (None, "é é 7 zz"), (90, None), (91, " .")]
    docs = [(i, make(rng, rng.randint(0, 60))) for i in range(60)] + [(60, None), (61, ""), (62, items[5][1] + ", x"), (62, items[5][1] + ", x")]
    docs += [(None, items[7][1] + " " + make(rng, 5)), (64, "x " * 3000 + items[9][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert digest(D.report(d, b, block_bytes=block_bytes)) == brute(docs, items)


def test_remove_keeps_columns_and_clean_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    d = spark.createDataFrame([(1, "q " * 500 + text, "x", 5), (2, text.upper(), "y", 6), (3, None, None, None), (4, text[:-20], "z", 7)],
                              "doc_id long, text string, _decon string, n_words long")
    b = spark.createDataFrame([(1, text)], "item_id long, text string")
    out = D.remove(d, b)
    assert out.columns == d.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_longest_match_and_place(spark):
    text = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(5, 25)) + " z")], "doc_id long, text string")
    b = spark.createDataFrame([(7, text), (8, " ".join(f"w{i}" for i in range(9, 24)))], "item_id long, text string")
    r = D.report(d, b).first()
    assert (r.longest_words, r.longest_start, r.longest_item, r.longest_item_start, r.item_ids) == (20, 2, "7", 5, ["7", "8"])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.report(d, b).collect()] == [(1, 2, 0, 0)]
    assert D.report(d.limit(0), b).count() == 0


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    tests = set()
    for _, t in items:
        w = words(t)
        tests |= {" " + " ".join(w[i:i + min(13, len(w))]) + " " for i in range(len(w) - min(13, len(w)) + 1)}
    near = [(d, t) for d, t in docs if any(x in " " + " ".join(words(t)) + " " for x in tests)][:15]
    got = {r.doc_id: (r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in D.op1_benchmark_decontamination(spark, sf).collect()}
    assert len(got) == len(docs) and near
    assert [got[r[0]] for r in brute(near, items)] == brute(near, items)
    assert sum(v[2] > 0 for v in got.values()) >= len(near)
