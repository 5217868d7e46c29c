"""Removal of repeated passages with super-k-mers.

A window is ``WINDOW`` consecutive words of one document.  A window's
minimiser is the least hash of its ``GRAM``-word sequences.  Consecutive windows
that share a minimiser travel together: their words, once, as one packed
string (a super-k-mer), to the bucket of the minimiser.  Equal windows have equal
minimisers, so each bucket can count its windows for itself: they are sorted by hash
and place, and equal hashes are confirmed on the words.

1. A first pass over the texts adds up the bytes for each bucket.  The number
   of buckets follows the size of all texts; a bucket that still gets too
   much (a very common minimiser) is divided by the hash of the whole window.
2. The second pass ships the windows.  A piece of a partition (a few
   megabytes) first drops the windows that it holds twice: all but the earliest
   are known to be repeated.  So a passage of a third of all documents is sent
   once per piece, not once per document.  The strings of a piece for one
   bucket travel as one compressed block.
3. The reducer takes one bucket at a time and reports, for each document, the
   windows that also start earlier.  These meet the document's text again, and
   the words that they cover go.

Earlier means: a smaller document id, or the same id and an earlier start.

Defined cases: a null or empty text has no words and gives an empty text; a
null id counts as the smallest; rows with the same id are one document
for the order, so windows at the same start of two such rows leave each other
alone, and they are told apart by a 64-bit hash of the text and its length in bytes; an empty table gives no rows; other columns pass through ``remove``,
whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import CHUNK_BYTES, Words, binary_list, chunks, released, rolling, table, text_bytes

WINDOW = 20
GRAM = 3
BUCKET_BYTES = 3 << 20
PIECE_BYTES = 6 << 20
#: Bytes of texts for each task of the counting.
PART_BYTES = 16 << 20
#: A bucket is divided if it gets more than this many times ``BUCKET_BYTES`` (about 3 are usual, as windows overlap).
DIVIDE = 12
_NO_ID = -(1 << 63)
_LOW = (1 << 64) - 1


def _tie(key: int, size: int) -> int:
    """What tells rows of one id apart, as one number: the text's length in bytes and its 64-bit hash."""
    return (size << 64) | (key & _LOW)


def _untie(tie: int) -> tuple[int, int]:
    """Hash (signed) and length of a tie."""
    key = tie & _LOW
    return key - (1 << 64) if key >> 63 else key, tie >> 64


def _packed(w: Words) -> tuple[bytes, np.ndarray]:
    """The words of ``w``, a space after each, and where each begins (one entry more than words)."""
    at = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
    mask = np.zeros(len(w.data) + 1, np.int8)
    mask[w.start] = 1
    mask[w.end + 1] -= 1
    keep = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)  # the words and the one byte after each
    data = w.data[keep].copy()
    data[at[1:] - 1] = 32
    return data.tobytes(), at


def _same(text, begin: np.ndarray, end: np.ndarray, run: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the windows ``p`` (ascending) and ``q`` have the same words; neighbours of one run are compared together."""
    out = np.ones(len(p), bool)
    if not len(p):
        return out
    new = (np.diff(p) != 1) | (np.diff(q) != 1)
    for x in (p, q):
        new |= run[x[1:]] != run[x[:-1]]
    cut = np.flatnonzero(new) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
    a, b, c, d = begin[p[first]], end[p[last]], begin[q[first]], end[q[last]]
    for i, j, s, e, x, y in zip(first.tolist(), last.tolist(), a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True):
        if text[s:e] != text[x:y]:
            for k in range(i, j + 1):
                out[k] = text[begin[p[k]] : end[p[k]]] == text[begin[q[k]] : end[q[k]]]
    return out


def _starts(words: Words, window: int) -> np.ndarray:
    """Whether a window of one text starts at each word."""
    n = np.diff(words.first)
    inside = np.arange(len(words.start)) - np.repeat(words.first[:-1], n)
    return inside + window <= np.repeat(n, n)


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    out, have = grams, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _runs(mask: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of the runs of neighbours in ``mask`` with equal ``keys``."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at
    new = np.diff(at) != 1
    for k in keys:
        new |= k[at[1:]] != k[at[:-1]]
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    return at[first], np.diff(np.concatenate([first, [len(at)]]))


class Piece:
    """Some documents: which windows repeat an earlier one here, and the super-k-mers of the others by bucket.

    A piece that is only ``measured`` finds the same super-k-mers but takes equal hashes for equal windows, and packs no words.
    """

    def __init__(self, ids, ties, texts, buckets: int, divided: dict[int, int], window: int, measured: bool = False):
        order = sorted(range(len(ids)), key=lambda i: (ids[i], ties[i]))
        self.ids, both = np.array([ids[i] for i in order], np.int64), [_untie(ties[i]) for i in order]
        self.ties, self.lengths = np.array([k for k, _ in both], np.int64), np.array([n for _, n in both], np.int64)
        w = Words([texts[i] for i in order])
        self.owner = np.repeat(np.arange(len(order), dtype=np.int32), np.diff(w.first))
        self.known = np.zeros(len(w.start), bool)
        self.first = self.count = self.bucket = np.zeros(0, np.int64)
        valid = _starts(w, window)
        if not valid.any():
            return
        self.start = (np.arange(len(w.start)) - w.first[self.owner]).astype(np.int32)
        self.window = window
        if measured:
            self.at = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
        else:
            self.text, self.at = _packed(w)
        hashes = w.hash
        del w
        grid = rolling(hashes, window)
        p, q = self._repeats(grid, valid[: len(grid)])
        if not measured:
            same = _same(self.text, self.at, self.at[window:], self.owner, p, q)
            p = p[same]
        self.known[p] = True
        del p, q
        least = _least(rolling(hashes, GRAM), window - GRAM + 1)
        del hashes
        bucket = (least % np.uint64(buckets)).astype(np.int32)
        part = np.zeros(len(grid), np.int32)
        for k, n in divided.items():
            chosen = bucket == k
            part[chosen] = (grid[chosen] >> np.uint64(20)) % np.uint64(n)
        del grid
        self.first, self.count = _runs((valid & ~self.known)[: len(least)], least, part)
        self.bucket = bucket[self.first] + buckets * part[self.first].astype(np.int64)

    def _repeats(self, grid: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (ascending) that start later than one with the same hash, and the earliest of those."""
        at = np.flatnonzero(valid).astype(np.int32)
        by = at[np.argsort(grid[at], kind="stable")]  # equal windows side by side, in the order of the documents
        key = grid[by]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        del at, key
        leader = by[np.maximum.accumulate(np.where(same, np.int32(0), np.arange(len(by), dtype=np.int32)))]
        p, q = by[same], leader[same]
        later = (self.ids[self.owner[p]] > self.ids[self.owner[q]]) | (self.start[p] > self.start[q])
        p, q = p[later], q[later]
        back = np.argsort(p)
        return p[back], q[back]

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes for each bucket met."""
        if not len(self.first):
            return self.bucket, self.bucket
        n = self.at[self.first + self.count + self.window - 1] - self.at[self.first]
        found, which = np.unique(self.bucket, return_inverse=True)
        return found, np.bincount(which, weights=n).astype(np.int64)

    def blocks(self):
        """``(bucket, block)`` for each bucket met: ids, ties, starts, numbers of windows and the packed strings."""
        order = np.argsort(self.bucket, kind="stable")
        edges = np.flatnonzero(np.diff(self.bucket[order])) + 1
        for runs in np.split(order, edges) if len(order) else []:
            first, count = self.first[runs], self.count[runs]
            s, e = self.at[first].tolist(), self.at[first + count + self.window - 1].tolist()
            text = b"".join([self.text[a:b] for a, b in zip(s, e, strict=True)])
            owner = self.owner[first]
            yield int(self.bucket[runs[0]]), _block(self.ids[owner], self.ties[owner], self.lengths[owner], self.start[first], count, text)

    def repeated(self):
        """``(id, tie, spans)`` for documents with windows known to be repeated; spans: start and number of windows, in turn."""
        first, count = _runs(self.known, self.owner)
        if len(first):
            owner, start = self.owner[first], self.start[first]
            yield from _spans(owner, self.ids, self.ties, self.lengths, start, count)


def _spans(owner, ids, ties, lengths, start, count):
    edges = np.flatnonzero(np.diff(owner)) + 1
    pairs = np.stack([start, count], 1)
    for k in np.split(np.arange(len(owner)), edges):
        d = owner[k[0]]
        yield int(ids[d]), _tie(int(ties[d]), int(lengths[d])), pairs[k].ravel().tolist()


def _block(ids, ties, lengths, starts, counts, text: bytes) -> bytes:
    raw = np.array([len(ids)], "<i8").tobytes() + ids.astype("<i8").tobytes() + ties.astype("<i8").tobytes()
    raw += lengths.astype("<i4").tobytes() + starts.astype("<i4").tobytes() + counts.astype("<i4").tobytes() + text
    return np.array([len(raw)], "<i8").tobytes() + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def _unblock(block: bytes):
    raw = pa.decompress(block[8:], decompressed_size=int(np.frombuffer(block[:8], "<i8")[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw[:8], "<i8")[0])
    large = np.frombuffer(raw, "<i8", 2 * n, 8)
    small = np.frombuffer(raw, "<i4", 3 * n, 8 + 16 * n).astype(np.int64)
    return large[:n], large[n:], small[:n], small[n : 2 * n], small[2 * n :], raw[8 + 28 * n :]


def _bucket_windows(blocks: list[bytes], window: int):
    """A bucket's runs (ids, ties, lengths, starts, counts), its words, and hash, run, first and last byte of every window.

    Some blocks at a time, so that only what stays of a word is held for the whole bucket.
    """
    runs, keys, of, begin, end, text = [], [], [], [], [], bytearray()
    n_runs = 0
    while blocks:
        some, size = [], 0
        while blocks and size < CHUNK_BYTES:
            some.append(_unblock(blocks.pop()))
            size += len(some[-1][5])
        counts = np.concatenate([p[4] for p in some])
        words = Words([b"".join([p[5] for p in some])])
        at = np.concatenate([[0], np.cumsum(words.end - words.start + 1)]) + len(text)
        first = np.concatenate([[0], np.cumsum(counts + window - 1)])[:-1]
        word = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        keys.append(rolling(words.hash, window)[word])
        of.append(np.repeat(np.arange(n_runs, n_runs + len(counts), dtype=np.int32), counts))
        begin.append(at[word])
        end.append(at[word + window])
        n_runs += len(counts)
        for p in some:
            text += p[5]
        runs.append([np.concatenate([p[k] for p in some]) for k in range(5)])
    return [np.concatenate([r[k] for r in runs]) for k in range(5)], text, *(np.concatenate(x) for x in (keys, of, begin, end))


def _count_bucket(blocks: list[bytes], window: int):
    """``(id, tie, spans)`` of the windows of one bucket that also start earlier; uses up ``blocks``."""
    (ids, ties, lengths, starts, counts), text, key, run, begin, end = _bucket_windows(blocks, window)
    before = np.cumsum(counts) - counts

    def place(i):  # windows to their documents and starts
        return ids[run[i]], starts[run[i]] + (i - before[run[i]])

    by = np.argsort(key)
    twice = np.zeros(len(by), bool)
    equal = key[by[1:]] == key[by[:-1]]
    twice[1:] |= equal
    twice[:-1] |= equal
    by = by[twice]
    doc, start = place(by)
    order = np.lexsort((start, doc, key[by]))
    by, doc, start = by[order], doc[order], start[order]
    head = np.concatenate([[True], key[by[1:]] != key[by[:-1]]]) if len(by) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))
    later = (doc > doc[lead]) | (start > start[lead])
    p, q = by[later], by[lead[later]]
    order = np.argsort(p)
    p, q = p[order], q[order]
    same = _same(text, begin, end, run, p, q)
    known = p[same]
    if not same.all():  # two sequences with one hash: those windows are grouped by their words
        groups: dict[bytes, list[tuple]] = {}
        odd = np.isin(key[by], key[p[~same]])
        for i, d, s in zip(by[odd].tolist(), doc[odd].tolist(), start[odd].tolist(), strict=True):
            groups.setdefault(bytes(text[begin[i] : end[i]]), []).append((i, d, s))
        extra = [i for g in groups.values() for i, d, s in g if (d, s) > g[0][1:]]
        known = np.unique(np.concatenate([known, np.array(extra, np.int64)]))
    if not len(known):
        return
    mask = np.zeros(len(run), bool)
    mask[known] = True
    at0, n = _runs(mask, run)
    owner = run[at0]
    yield from _spans(owner, ids, ties, lengths, place(at0)[1], n)


_FLAGS = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("size", pa.int32()), ("spans", pa.list_(pa.int32()))])


def _flag_batch(rows: list[tuple]) -> pa.RecordBatch:
    flat = [(d, *_untie(tie), spans) for d, tie, spans in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in flat], t) for k, t in enumerate(_FLAGS.types)], schema=_FLAGS)


def _pieces(batches, buckets: int, divided: dict[int, int], window: int, measured: bool = False):
    for b in batches:
        texts, ids = binary_list(b.column("body")), b.column("id").to_pylist()
        ties = [_tie(k, n) for k, n in zip(b.column("tie").to_pylist(), b.column("size").to_pylist(), strict=True)]
        for i, j in chunks(texts, PIECE_BYTES):
            yield Piece(ids[i:j], ties[i:j], texts[i:j], buckets, divided, window, measured)


def repeated(slim: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(id, tie, size, spans)`` for documents with windows that also start earlier; of ``(id, tie, size, body)``."""
    spark = slim.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = text_bytes(slim, "body")
    buckets = max(4 * wide, math.ceil(size / bucket_bytes))
    parts = max(wide, math.ceil(size / PART_BYTES))

    def measure(batches):
        for p in _pieces(batches, buckets, {}, window, measured=True):
            found, n = p.sizes()
            del p  # not beside the next piece
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["bucket", "n"])

    limit = DIVIDE * bucket_bytes
    heavy = slim.mapInArrow(released(measure), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > limit)
    divided = {r.bucket: math.ceil(r.n / (3 * bucket_bytes)) for r in heavy.collect()}  # few: each holds many buckets' share

    def ship(batches):
        for p in _pieces(batches, buckets, divided, window):
            rows = [(k, block) for k, block in p.blocks()]
            flags = list(p.repeated())
            for i in range(0, len(flags), 512):  # known already: these only pass through
                rows.append((-1 - i // 512 - 31 * int(p.ids[0] & 0xFFFF), _flag_batch(flags[i : i + 512]).serialize().to_pybytes()))
            del p, flags
            made = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "block"])
            del rows
            yield made

    def count(batches):
        bucket, blocks = None, []
        for b in batches:
            for k, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k < 0:
                    yield pa.ipc.read_record_batch(pa.py_buffer(block), _FLAGS)
                    continue
                if k != bucket and blocks:
                    yield _flag_batch(list(_count_bucket(blocks, window)))
                    blocks = []
                bucket = k
                blocks.append(block)
        if blocks:
            yield _flag_batch(list(_count_bucket(blocks, window)))

    shipped = slim.mapInArrow(released(ship), "bucket long, block binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    flags = shipped.mapInArrow(released(count), "id long, tie long, size int, spans array<int>")
    return flags.groupBy("id", "tie", "size").agg(F.flatten(F.collect_set("spans")).alias("spans"))  # rows that repeat a document have equal spans


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES,
           keep: list[str] | None = None, made: str = "_cut") -> DataFrame:
    """``keep`` columns (all) and the struct ``made``: ``n_words``, ``n_removed`` and ``text``, the words that stay, one space between."""
    keep = docs.columns if keep is None else keep
    names = {c: f"c{i}" for i, c in enumerate(keep)}
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID))
    body = F.col(f"`{text_col}`")
    wide = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()], key.alias("id"), F.xxhash64(body).alias("tie"),
                       F.coalesce(F.octet_length(body), F.lit(0)).alias("size"), body.alias("body"))
    found = repeated(wide.select("id", "tie", "size", "body"), window, bucket_bytes)
    joined = wide.join(found, ["id", "tie", "size"], "left")
    cut = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
    carried = list(names.values())
    schema = joined.select(*carried, F.expr("cast(null as struct<n_words:long,n_removed:long,text:string>)").alias("_cut")).schema

    def work(batches):
        for b in batches:
            made = []
            for text, spans in zip(binary_list(b.column("body")), b.column("spans").to_pylist(), strict=True):
                words = text.split()
                n, left = len(words), words
                if spans:
                    edge = np.zeros(n + window + 1, np.int64)
                    s, c = np.array(spans[::2]), np.array(spans[1::2])
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + c + window - 1, -1)
                    gone = np.cumsum(edge)[:n] > 0
                    left = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                made.append({"n_words": n, "n_removed": n - len(left), "text": b" ".join(left).decode("utf-8", "replace")})
            yield pa.RecordBatch.from_arrays([b.column(c) for c in carried] + [pa.array(made, cut)], names=[*carried, "_cut"])

    out = joined.mapInArrow(released(work), schema)
    return out.select(*[F.col(a).alias(c) for c, a in names.items()], F.col("_cut").alias(made))


def replace(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **names) -> DataFrame:
    """The documents with shortened texts (and, where there is such a column, their new lengths); a text without repeats stays as it is."""
    made = "_cut"
    while made in docs.columns:
        made += "_"
    found = remove(docs, id_col, text_col, made=made, **names)
    cut, new = F.col(f"{made}.n_removed") > 0, F.col(f"{made}.text")
    changed = {text_col: F.when(cut, new).otherwise(F.col(f"`{text_col}`"))}
    if length_col in docs.columns:
        changed[length_col] = F.when(cut, F.length(new)).otherwise(F.col(f"`{length_col}`")).cast(docs.schema[length_col].dataType)
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: words, words removed and a digest of those that stay."""
    out = remove(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", F.col("_cut.n_words").alias("n_words"), F.col("_cut.n_removed").alias("n_removed"),
                      F.sha2(F.col("_cut.text"), 256).alias("kept_sha256"))
