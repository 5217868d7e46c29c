"""Repeated passages against a plain dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fuelsight.llm import common as C
from fuelsight.llm import substrings as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=20):
    first = {}
    for d, t in docs:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (1e99, 0)), (-1e99 if d is None else d, i))
    out = []
    for d, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (-1e99 if d is None else d, i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **names):
    rows = S.remove(df, **names).select("doc_id", "_cut.n_words", "_cut.n_removed", F.sha2("_cut.text", 256).alias("h")).collect()
    return sorted([tuple(r) for r in rows], key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "the", "The", "a,"]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [make(rng.randint(20, 60)) for _ in range(6)]
    docs = []
    for _ in range(150):
        x = make(rng.randint(0, 50))
        for _ in range(rng.randint(0, 2)):
            x += rng.choice(passages)[rng.randint(0, 15):] + make(rng.randint(0, 30))
        docs.append(rng.choice([" ", "\n", " \t"]).join(x))
    docs += [None, "", "  ", "x " * 70, docs[3], docs[3], " ".join(passages[0] * 3)]
    return list(enumerate(docs))


@pytest.mark.parametrize("piece,bucket,divide", [(8 << 20, 2 << 20, 12), (600, 2 << 20, 12), (600, 300, 0.2)])
def test_equals_brute_force(spark, monkeypatch, piece, bucket, divide):
    monkeypatch.setattr(S, "PIECE_BYTES", piece)
    monkeypatch.setattr(S, "DIVIDE", divide)
    docs = corpus(piece + bucket)
    # pieces are cut on the executors, whose modules the patch does not reach: give them small batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000 if piece > 600 else 7)
    try:
        d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, body string").repartition(5)
        assert got(d, bucket_bytes=bucket) == brute(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    docs = [(5, text), (5, "x y " + text), (5, text), (None, "a " + text), (7, text + " end"), (1, "b")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(d) == brute(docs)


def test_rows_of_one_id_with_one_short_hash(spark):
    """Two texts without an id and with the same 32-bit hash: what repeats in one is not cut from the other."""
    text = " ".join(f"t{i}" for i in range(30))
    docs = [(None, text), (None, "x58511 " + text), (None, "y82784")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert len({r.h for r in d.select(F.hash("text").alias("h")).collect()}) == 2
    assert got(d) == brute(docs)


def test_many_rows_of_one_document(spark):
    """A third of all rows repeat one document: each gets the spans of its text once."""
    text = " ".join(f"t{i}" for i in range(60))
    docs = [(1, "a " + text)] + [(2, text)] * 2000 + [(3, "b " + text)] * 50 + [(i, f"c{i}") for i in range(4, 2000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(d) == brute(docs)
    slim = d.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), F.octet_length("text").alias("size"), F.col("text").alias("body"))
    found = {r.id: len(r.spans) for r in S.repeated(slim).collect()}
    assert set(found) == {2, 3} and max(found.values()) < 1000


def test_collisions_of_the_hash_are_told_apart(monkeypatch):
    """With one hash for every word, only the words themselves can tell windows apart."""
    monkeypatch.setattr(C.Words, "_hashes", lambda self, data: np.zeros(len(self.start), np.uint64))
    texts = [" ".join(f"t{i}" for i in range(22)), " ".join(f"u{i}" for i in range(22)), " ".join(f"t{i}" for i in range(1, 22))]
    blocks = []
    for k, t in enumerate(texts):
        blocks += [b for _, b in S.Piece([k], [0], [t.encode()], 1, {}, 20).blocks()]
    assert list(S._count_bucket(blocks, 20)) == [(2, 0, [0, 2])]


def test_remove_carries_columns(spark):
    d = spark.createDataFrame([(1, "a  b", "x", "y", "z")], "doc_id long, text string, id string, `a.b` string, spans string")
    out = S.remove(d)
    assert out.columns == [*d.columns, "_cut"] and out.first()["_cut"].text == "a b"
    assert S.remove(d.limit(0)).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in S.op7_substring_dedup(spark, sf).collect()], key=str) == brute(docs)
