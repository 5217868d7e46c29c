"""Archives: standard-conforming members, index lookups against a plain dictionary, the query against DuckDB."""

import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

from fuelsight.llm import warc as W

BIG = "x" * 1500 + "é"
PAGES = [(1, "http://www.Example.com/a?q=1#f", BIG), (2, "https://example.com", BIG), (9, "http://b.org:80/\r\nx y", BIG), (3, "http://b.org/s", "small"),
         (4, "http://b.org/s", "small"), (5, None, None), (6, "no url at all", ""), (None, "http://b.org/n", BIG), (9, "http://b.org/again", BIG),
         (7, "http://[bad/", "\r\n\r\nWARC/1.1\r\n" * 100), (8, "http://b.org/s", "y" * 1000), (11, "http://b.org/s", "y" * 1000), (12, "u", "z" * 999), (13, "u", "z" * 999)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "out")
    d = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    captures = W.write(d, folder)
    return folder, captures, W.build_index(captures, folder, block_lines=2)


def test_records(stored):
    folder, _, blocks = stored
    rows = W.read_all(blocks, folder).collect()
    got = sorted((r.page, r.payload_bytes, r.digest, r.type, r.refers_to or "", r.payload is None) for r in rows)
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if h == html and p is not None]
        keeper = max(same) if len(body) >= 1000 and same else page
        again = len(body) >= 1000 and keeper != page
        want.append((str(page) if page is not None else "null", len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                     str(keeper) if again else "", again))
    assert got == sorted(want)


def test_files_are_gzip_members_of_whole_records(stored):
    folder, captures, _ = stored
    n = 0
    for f in Path(folder).glob("*.warc.gz"):
        raw = gzip.decompress(f.read_bytes())
        while raw:
            assert raw.startswith(b"WARC/1.1\r\n")
            head, _, rest = raw.partition(b"\r\n\r\n")
            size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            raw, n = rest[size + 4:], n + 1
    assert n == len(PAGES) == captures.count()


def test_lookup(spark, stored):
    folder, _, blocks = stored
    by_key = defaultdict(list)
    for page, url, _ in PAGES:
        by_key[W.key_of(url)].append(str(page) if page is not None else "null")
    urls = [u for _, u, _ in PAGES] + ["http://absent.org/", "http://b.org/s"]
    rows = W.lookup(spark.createDataFrame([(u,) for u in urls], "url string"), blocks, folder).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.key].append(r.page)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_key.items()}


def test_keys():
    assert W.key_of("https://U:p@Blog.Example.com:8443/A/b?x=1#top") == "com,example,blog)/A/b?x=1"
    assert W.key_of("http://example.com") == "com,example)/" and W.key_of(None) == ""


def test_damage_is_noticed():
    raw = W.record("1", "http://a.b/", b"hello", hashlib.sha1(b"hello").hexdigest(), None)
    assert W.parse(raw)["payload"] == b"hello"
    with pytest.raises(ValueError):
        W.parse(raw.replace(b"hello", b"hellp"))


def test_empty(spark, tmp_path):
    d = spark.createDataFrame([], "page_id long, url string, html string")
    blocks = W.build_index(W.write(d, f"{tmp_path}/e"), f"{tmp_path}/e")
    assert W.read_all(blocks, f"{tmp_path}/e").count() == 0


def test_query_equals_duckdb(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    df = W.op6_warc(spark, sf)
    got = con.execute(W.ORACLE)
    assert [x[0] for x in got.description] == df.columns
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, got.fetchall()))
