"""WARC archives with a two-level capture index.

``write`` stores one record per page.  Of the pages with an equal payload of
``LEAST_REVISIT`` bytes or more, the one with the largest id is a ``response`` and
the others are ``revisit`` records that refer to it; all smaller ones are responses.  Each
record is a gzip member of its own, so it can be read by its byte range.

The index holds a line per capture: key, page, archive, offset and length.  The key is
the URL with its host reversed (``com,example,www)/path``), so the captures of a
site lie together.  Lines are sorted over all partitions and cut into
compressed blocks; beside each index file lies a sparse directory with the
first key and the byte range of every block.  ``lookup`` finds the index file
by the files' first keys (one per partition of the sort), binary-searches the directory, reads one block by its
range, binary-searches that, and reads the records by theirs.  ``read_all`` goes
through every block.

Archives, blocks and directories are written and read through pyarrow's file
systems under the shared folder, which executors must reach under the same
address.  A repeated task writes files of its own; only those of the attempts whose
rows arrive are referred to.

Defined cases: a null html is an empty payload; a null URL has the empty key; pages
with a null id count as the smallest; of repeated rows with the largest id,
each is a response; control characters in URLs are percent-encoded; an
empty table gives no archives and no rows; further columns do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from bisect import bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import binary_list, materialize, released, table
from fuelsight.session import scratch_path

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 500
DATE = "2024-01-01T00:00:00Z"
#: Fixed value of the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CAPTURE = "key string, page string, archive string, offset long, length long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and path for a folder named as Spark names it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", re.sub(r"^s3[an]:", "s3:", uri)))


def key_of(url: str | None) -> str:
    """The URL with its host reversed, in lower case and without scheme, user, port and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    path = parts.path or "/"
    return ",".join(reversed(host.split("."))) + ")" + path + (f"?{parts.query}" if parts.query else "")


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in hex."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = {
        "WARC-Type": "revisit" if refers_to else "response", "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": DATE,
        "WARC-Target-URI": _clean(url) if url else "urn:page:unknown",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    }
    if refers_to:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers, payload length, digest and (for responses) payload of a record; the stored digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not fit its digest")
    page = lambda v: v and v.removeprefix("<urn:page:").removesuffix(">")
    return {"page": page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "type": fields["WARC-Type"], "bytes": size,
            "digest": digest, "refers_to": page(fields.get("WARC-Refers-To")), "payload": payload if fields["WARC-Type"] == "response" else None}


def _attempt(name: str, n: int = 0) -> str:
    c = TaskContext.get()
    return f"{name}-{c.partitionId():06d}-{c.taskAttemptId()}-{n}"


def write(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes the archives below ``folder`` and returns the captures, written once: key, page, archive, offset, length."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    slim = slim.withColumn("digest", F.sha1("html")).withColumn("large", F.octet_length("html") >= least)
    keepers = slim.filter("large").groupBy("digest").agg(F.max("page_id").alias("keeper"), F.lit(True).alias("large"))
    rows = slim.join(keepers, ["digest", "large"], "left")
    refers = F.when(F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper"))
    rows = rows.select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page"), "url", "html", "digest",
                       refers.cast("string").alias("refers"))

    def store(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, at, n = None, 0, 0
        try:
            for b in batches:
                found = []
                columns = [b.column(c).to_pylist() for c in ("page", "url", "digest", "refers")]
                for page, url, digest, refers, payload in zip(*columns, binary_list(b.column("html")), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = _attempt("pages", n) + ".warc.gz", 0
                        out, n = fs.open_output_stream(f"{root}/{name}", compression=None), n + 1
                    data = gzip.compress(record(page, url, payload, digest, refers), 6, mtime=0)
                    out.write(data)
                    found.append((key_of(url), page, name, at, len(data)))
                    at += len(data)
                yield _batch(found, [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()], ["key", "page", "archive", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return materialize(rows.mapInArrow(released(store), _CAPTURE), "captures")


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes index files with their directories; returns one row per block: file, first and last key, offset, length, lines."""
    spark = captures.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page", "archive", "offset").sortWithinPartitions("key", "page", "archive", "offset")

    def store(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name, out, at, lines, entries = _attempt("index"), None, 0, [], []

        def close():
            nonlocal out, at
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}.idx", compression=None)
            data = zlib.compress(json.dumps(lines).encode(), 6)
            out.write(data)
            entries.append((lines[0][0], lines[-1][0], at, len(data), len(lines)))
            at += len(data)
            lines.clear()

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                lines.append(row)
                if len(lines) == block_lines:
                    close()
        if lines:
            close()
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.dir", compression=None) as f:
                f.write(json.dumps(entries).encode())
        yield _batch([(name, *e) for e in entries], [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()],
                     ["file", "first", "last", "offset", "length", "lines"])

    return materialize(ordered.mapInArrow(released(store), "file string, first string, last string, offset long, length long, lines long"), "blocks")


class _Reader:
    """Byte ranges of files below a folder; a few files stay open."""

    def __init__(self, folder: str):
        (self.fs, self.root), self.open = file_system(folder), {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        f = self.open.get(name)
        if f is None:
            if len(self.open) > 32:
                self.open.pop(next(iter(self.open))).close()
            f = self.open[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return f.read_at(length, offset)

    def whole(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return f.read()

    def block(self, file: str, offset: int, length: int) -> list[list]:
        return json.loads(zlib.decompress(self.read(f"{file}.idx", offset, length)))

    def record(self, archive: str, offset: int, length: int) -> dict:
        return parse(gzip.decompress(self.read(archive, offset, length)))


_RECORD = "key string, page string, url string, type string, payload_bytes long, digest string, refers_to string, payload binary"
_TYPES = [*[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.binary()]
_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


def _records(reader: _Reader, lines, with_payload: bool):
    """Records of index lines, by archive and offset, a bounded number at a time."""
    rows, size = [], 0
    for key, _, archive, offset, length in sorted(lines, key=lambda x: (x[2], x[3])):
        r = reader.record(archive, offset, length)
        payload = r["payload"] if with_payload else None
        rows.append((key, r["page"], r["url"], r["type"], r["bytes"], r["digest"], r["refers_to"], payload))
        size += len(payload or b"") + 200
        if size > 8 << 20:
            yield _batch(rows, _TYPES, _NAMES)
            rows, size = [], 0
    if rows:
        yield _batch(rows, _TYPES, _NAMES)


def read_all(blocks: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, found through the blocks of the index."""

    def work(batches):
        reader = _Reader(folder)
        for b in batches:
            for file, offset, length in zip(*[c.to_pylist() for c in b.columns], strict=True):
                yield from _records(reader, reader.block(file, offset, length), with_payload)

    return blocks.select("file", "offset", "length").repartition("file", "offset").mapInArrow(released(work), _RECORD)


def lookup(urls: DataFrame, blocks: DataFrame, folder: str, url_col: str = "url", with_payload: bool = True) -> DataFrame:
    """The records of the given URLs, each URL's captures once however often it is asked for."""
    files = blocks.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()  # one per partition of the sort
    files = sorted((r["first"], r["last"], r["file"]) for r in files)

    def route(batches):
        firsts = [f[0] for f in files]
        for b in batches:
            rows = []
            for url in b.column(0).to_pylist():
                key = key_of(url)
                k = bisect_right(firsts, key) - 1
                while k >= 0 and files[k][1] >= key:  # equal keys may go over several files
                    rows.append((files[k][2], key))
                    k -= 1
            yield _batch(rows, [pa.string(), pa.string()], ["file", "key"])

    def find(batches):
        reader, directories = _Reader(folder), {}
        for b in batches:
            for file, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if file not in directories:
                    directories = {file: json.loads(reader.whole(f"{file}.dir"))}
                entries = directories[file]
                k, lines = bisect_right(entries, key, key=lambda e: e[0]) - 1, []
                while k >= 0 and entries[k][1] >= key:
                    block = reader.block(file, entries[k][2], entries[k][3])
                    to = bisect_right(block, key, key=lambda x: x[0])
                    while to and block[to - 1][0] == key:
                        to -= 1
                        lines.append(block[to])
                    k -= 1
                yield from _records(reader, lines, with_payload)

    routed = urls.select(F.col(url_col)).mapInArrow(released(route), "file string, key string").distinct()
    return routed.repartition("file", "key").sortWithinPartitions("file", "key").mapInArrow(released(find), _RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, indexed, and read back through the index."""
    folder = scratch_path(spark, "warc")
    blocks = build_index(write(table(spark, sf_dir, "pages"), folder), folder)
    back = read_all(blocks, folder, with_payload=False)
    page = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("long")
    return back.select(page("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                       page("refers_to").alias("refers_to"), "key")


ORACLE = """
    with p as (
        select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest, octet_length(encode(coalesce(html, ''))) as size from pages),
    k as (select digest, max(page_id) as keeper from p where size >= 1000 group by digest)
    select page_id, size::bigint as payload_bytes, digest as payload_digest,
           case when size >= 1000 and page_id <> keeper then 'revisit' else 'response' end as record_type,
           case when size >= 1000 and page_id <> keeper then keeper end as refers_to,
           array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '.')), ',') || ')'
           || regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) as key
    from p left join k using (digest)"""
