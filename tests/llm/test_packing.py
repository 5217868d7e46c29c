"""Packing: exact ids, no token lost or twice, full windows, best fill against enumeration."""

import itertools
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fuelsight.llm.packing import best_fill, op3_packing, pack
from fuelsight.llm.subwords import Subwords, vocabulary_path


def test_best_fill_is_the_best_sum():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 15) for _ in range(rng.randint(0, 8))]
        cap = rng.randint(0, 40)
        counts = {x: lengths.count(x) for x in lengths}
        taken = best_fill(counts, cap)
        assert all(0 < k <= counts[x] for x, k in taken.items())
        best = max(s for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= cap)
        assert sum(x * k for x, k in taken.items()) == best


def test_word_ids_equal_text_ids():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello, wörld!  it's  100%\n\tÉcole x y", "", " ", "a<|endoftext|>b <|startoftext|>", "\x00 a\x00b \x1c c\x85d",
             "é ́e 한국 漢字かな", "İSTANBUL Σίσυφος ΣΑΣ", "a" * 5000, "x's 'S ''ll"]
    flat, n = Subwords(vocabulary_path()).ids([x.encode() for x in texts])
    got = np.split(flat, np.cumsum(n)[:-1])
    assert [g.tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def check(pieces, docs, capacity):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for d, text in docs:
        want = t.encode(text or "", add_special_tokens=False).ids + [2]
        rows = sorted(by_doc[d], key=lambda r: r.start)
        assert [r.start for r in rows] == list(itertools.accumulate([0] + [r.length for r in rows[:-1]]))
        assert np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist() == want
        assert {r.doc_tokens for r in rows} == {len(want)}
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == list(itertools.accumulate([0] + [r.length for r in rows[:-1]]))
        total = sum(r.length for r in rows)
        assert total == capacity or total & (total - 1) == 0 and total < capacity


def test_edge_cases(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "bb", "Ccc", "ñandú,"]) for _ in range(rng.randint(0, 90)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "word " * 2000), (None, "x y")]
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, ids string").repartition(2)
    check(pack(d, capacity=64, pool_tokens=300).collect(), docs, 64)
    assert pack(d.limit(0)).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(pack(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], 4096)
    assert op3_packing(spark, sf).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
