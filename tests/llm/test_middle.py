from __future__ import annotations

import hashlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from fuelsight.llm import middle as M

SF = "/root/testdata/sf0.001"


def plain_output(doc_id, text):
    """The contract written down on strings."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(rows, docs):
    texts = {i: t for i, t in docs}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in docs)
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_output(r.doc_id, texts[r.doc_id])
        assert r.restored == (texts[r.doc_id] or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<PSM> é漢😀\n", max_size=40), st.integers(0, 10**9))
def test_rotations_invert(text, doc_id):
    data = text.encode()
    at = M.code_points(data)
    assert len(at) - 1 == len(text)
    form, a, b = M.plan(doc_id, data, len(text))
    out = M.rearrange(data, form, int(at[a]), int(at[b]))
    assert out.decode() == plain_output(doc_id, text)[4]
    assert M.rebuild(bytes(out), form).decode() == text


def test_rotation_exchanges_neighbours():
    for a in range(4):
        for m in range(a, 9):
            for b in range(m, 12):
                buf = bytearray(range(12))
                want = buf[:a] + buf[m:b] + buf[a:m] + buf[b:]
                M.rotate(M.np.frombuffer(buf, M.np.uint8), a, m, b)
                assert buf == want


def test_edge_cases(spark):
    docs = [(i, f"word {i} ünï 😀 " * (i % 7 + 1)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "é" * 3_000_000), (103, "has <M> in it"), (104, "<"), (None, "no id"), (-5, "<S"), (105, "P>" * 9)]
    rows = [(i, t, "z", i) for i, t in docs]
    d = spark.createDataFrame(rows, "doc_id long, text string, output string, n long").repartition(3)
    check(M.restore(M.transform(d)).collect(), docs)
    assert M.digest(M.restore(M.transform(d.limit(0)))).count() == 0
    twice = M.transform(d.where("doc_id < 5").union(d.where("doc_id < 5")))
    assert twice.count() == 10 + 2 and twice.distinct().count() == 5 + 1


def test_every_form_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = M.restore(M.transform(docs)).collect()
    check(rows, [tuple(r) for r in docs.collect()])
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duck.sql(M.ORACLE)
    got = M.op12_fill_in_middle(spark, SF)
    assert got.columns == want.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
