"""The pipeline against a plain version of every stage."""

import itertools
import re
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from fuelsight.llm import quality as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BARE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def near(docs):
    sets = {}
    for d, t in docs.items():
        w = WORD.findall(lower(t))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    top = {d: d for d in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
            i, j = sorted((find(a), find(b)))
            top[j] = i
    return {d: t for d, t in docs.items() if find(d) == d}


def cut(docs):
    first, out = {}, {}
    for d in sorted(docs):
        w = WORD.findall(docs[d])
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i:i + 20]), (d, i))
    for d, t in docs.items():
        w = WORD.findall(t)
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] != (d, i):
                gone.update(range(i, i + 20))
        out[d] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t
    return out


def clean(docs, items):
    tests = set()
    for t in items:
        w = BARE.findall(lower(t or ""))
        n = min(13, len(w))
        tests |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
    lengths = {len(t) for t in tests}
    out = {}
    for d, t in docs.items():
        w = BARE.findall(lower(t))
        hit = {p for n in lengths for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in tests for p in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out[d] = t
    return out


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = {r.doc_id: r.text for r in Q.judge(docs).filter("_p.kept").collect()}  # its own tests hold it against plain versions
    steps = [plain, near(plain)]
    steps.append(cut(steps[-1]))
    steps.append(clean(steps[-1], items))
    now = docs
    for (name, stage), want in zip(P.STAGES, steps):
        now = stage(spark, now, SF)
        assert now.columns == docs.columns and now.schema == docs.schema, name
        assert {r.doc_id: r.text for r in now.collect()} == want, name
    assert len(steps[0]) > len(steps[1]) and steps[1] != steps[2] and len(steps[2]) > len(steps[3])
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(int)
    for r in P.run(spark, SF).collect():
        pieces[r.doc_id] += r.length
    assert dict(pieces) == {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in steps[-1].items()}


def test_nulls_and_clashing_columns(spark):
    d = spark.createDataFrame([(None, None, "a", None), (1, "word " * 10, "b", 50), (None, " ".join(f"w{i} good" for i in range(40)), "c", 9)],
                              "doc_id long, text string, _cut string, n_chars long")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, d, SF).columns == d.columns
        assert stage(spark, d.limit(0), SF).count() == 0
    assert P.STAGES[-1][1](spark, d, SF).count() >= 3
