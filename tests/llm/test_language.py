"""Language identification: the fused posterior against plain Python, accuracy on held-out texts, and what each evidence does."""

import math
import time
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fuelsight.llm import language as G

SF = "/root/testdata/sf0.01"


def plain(rows, k):
    """The formula, page by page; rows: (id, declared, host, domain, address, text)."""

    def soft(v):
        e = [math.exp(x - max(v)) for x in v]
        return [x / sum(e) for x in e]

    share = [soft(r[5]) for r in rows]
    by = {n: defaultdict(lambda: [0.0] * k) for n in (1, 2, 3, 4)}
    total = [sum(s[i] for s in share) for i in range(k)]
    for r, s in zip(rows, share):
        for n, t in by.items():
            if r[n] is not None:
                t[r[n]] = [a + b for a, b in zip(t[r[n]], s)]
    out = {}
    for r, s in zip(rows, share):
        of = [(x + 1) / (sum(total) + k) for x in total]
        for n, prior in ((3, G.DOMAIN_PRIOR), (2, G.HOST_PRIOR)):
            c = [max(a - b, 0) for a, b in zip(by[n][r[n]], s)] if r[n] is not None else [0.0] * k
            of = [(a + prior * b) / (sum(c) + prior) for a, b in zip(c, of)]
        z = [x + math.log(y) for x, y in zip(r[5], of)]
        for n in (1, 4):
            if r[n] is not None:
                z = [a + math.log((by[n][r[n]][i] - s[i] + G.VALUE_PRIOR) / (total[i] + G.VALUE_PRIOR * (len(by[n]) + 1))) for i, a in enumerate(z)]
        out[r[0]] = max(soft(z))
    return out


def test_fusion_equals_plain_formula(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages"))
    langs, model = G.train(docs)
    assert langs == sorted(r.lang for r in docs.select("lang").distinct().collect() if r.lang)
    found = G.evidence(pages.limit(120), langs, model).collect()
    found = [tuple(r) for r in found] + [(9001, None, None, None, None, [0.0] * len(langs)), (9002, "xx", None, None, None, [0.0] * len(langs))]
    d = spark.createDataFrame(found, "page_id long, declared string, host string, domain string, address string, text array<double>")
    got = {r.page_id: r.probability for r in G.fuse(d, langs).collect()}
    want = plain(found, len(langs))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-6)


def test_held_out_texts(spark):
    """Documents as bare pages, trained on the others."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text is not null and lang is not null and length(text) > 100")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    pages = docs.filter(part).select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"), "lang")
    got = {r.page_id: r.lang for r in G.identify(pages, docs.filter(~part)).collect()}
    want = {r.page_id: r.lang for r in pages.collect()}
    assert len(want) > 100 and sum(got[k] == v for k, v in want.items()) >= 0.95 * len(want)


def test_query(spark):
    rows = G.op4_language_id(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(0 < r.probability <= 1 and r.lang for r in rows)


def test_evidence_parts():
    assert G.address("https://Blog.shop.example.fr:80/de-AT/x?y") == ("blog.shop.example.fr", "example.fr", "fr/de")
    assert G.address("http://a.com/index") == ("a.com", "a.com", "com/") and G.address(None) == (None, None, None)
    assert G.address("http://[bad/") == (None, None, None)
    assert G.declared(b'<!doctype html><HTML class=x LANG="pt-BR">') == "pt" and G.declared(b"<p lang=de>") is None
    assert G.declared(b'<meta http-equiv="Content-Language" content="es">') == "es"
    assert G.visible(b"<p>a&eacute;<script>no</script><!-- no --> b</p>").split() == ["aé".encode(), b"b"]


def test_context_decides_where_the_text_is_silent(spark):
    docs = spark.createDataFrame([("der und die das nicht ein " * 5, "de"), ("the and of that not one " * 5, "en"), (None, "en"), ("x", None)], "text string, lang string")
    de, en = "der und die das nicht ein", "the and of that not one"
    pages = [(i, f"http://h.de/{i}", de) for i in range(20)] + [(100 + i, f"http://h.com/{i}", en) for i in range(20)]
    pages += [(50, "http://h.de/empty", ""), (51, "http://h.com/empty", None), (52, None, None), (None, "http://h.de/n", de), (0, "http://h.de/0", de)]
    got = [(r.page_id, r.lang) for r in G.identify(spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, lang string"), docs).collect()]
    by = dict(got)
    assert len(got) == len(pages) and by[50] == "de" and by[51] == "en" and by[52] in ("de", "en") and by[None] == "de"


def test_empty_tables(spark):
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    pages = spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, html string")
    assert G.identify(pages.limit(0), docs).count() == 0
    assert [(r.page_id, r.lang) for r in G.identify(pages, docs.limit(0)).collect()] == [(1, None)]


@pytest.mark.parametrize("unit", [b"<!--", b"<meta ", b"<script>", b"<html lang ", b"<", b"<!-- <script>", b"</script <style>", b"<style></style "])
def test_hostile_pages_take_linear_time(unit):
    """Four megabytes of tags, comments or elements without an end."""
    page = unit * (4_000_000 // len(unit))
    start = time.process_time()
    G.visible(page), G.declared(page)
    assert time.process_time() - start < 3


def test_what_is_left_open_in_a_page():
    assert G.visible(b"a<!-- b <i>c</i> d").split() == [b"a", b"c", b"d"]  # a comment without an end is a tag
    assert G.visible(b"a<script>b</i> c <style>x</style>d").split() == [b"a", b"b", b"c", b"d"]
    assert G.visible(b"a <b").split() == [b"a", b"<b"] and G.visible(b"") == b""
    assert G.declared(b"<html <html lang=fr") == "fr" and G.declared(b"<html ><p lang=de>") is None
    assert G.declared(b'<meta name=x content="en"><meta property="og:locale" content="it_IT">') is None
    assert G.declared(b'<meta property="og:locale" content="it">') == "it"
