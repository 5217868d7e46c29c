"""Alignment of two tokenizers over the same texts, merged in lockstep.

Both tokenizers cover the bytes of space + text.  One NumPy state vector holds, for every
document of a piece at once, how far the merge has come in the tokens of A and of B; each step links
the two tokens that every pointer pair stands on, cuts where both end at the same byte, and
advances whichever ends first (both at a cut).  Documents that are done leave the vector.  So that a long
document does not keep the vector short, it has a pointer pair for every ``LANE`` tokens of A: a pair starts
where its first A token starts, on the B token that covers that byte, which is a state that
the merge from the front would pass through as well.

Counts of linked id pairs are corpus-wide: a task counts the pairs of about ``CHUNK_BYTES`` of texts, the
chunks' counts are added up by pair, and each chunk gets the totals of its own pairs back.  What travels is one row
per chunk and distinct pair; a document's links stay in its chunk as numbers of distinct pairs.  No table is broadcast but the
highest count of each id of B, one row per entry of the vocabulary.

A is read from the rank file of its vocabulary, which gives the same ids as its JSON form (tests compare them) at a third of the time; only a part with a very long run of white space goes through the JSON form.
Long texts are tokenized in parts, cut at a space between two ASCII letters, where neither tokenizer merges; a task holds
the ids and byte ends of one chunk, or of one longer document.

Defined cases: a null or empty text, and one whose joined bytes of A or B differ from space + text (as with U+2581, or bytes that are not UTF-8), has no tokens and
only zeros; rows that repeat a document or have a null id are aligned each, and their links count each; an empty table gives no rows;
other columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import binary_list, chunks, materialize, released, table
from fuelsight.llm.subwords import vocabulary_path

RANKS_A, JSON_A, MODEL_B = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20
LANE = 256
_PART = 1 << 20
_SAFE_CUT = re.compile(rb"[A-Za-z] [A-Za-z]")
_LONG_RUN = re.compile(r"\s{50000}")  # the pattern of the rank file looks ahead over all of a run, and gives up on very long ones

_LONGS = ("n_a", "n_b", "n_groups", "n_links")


class Tokenizers:
    """Both tokenizers, the bytes of every entry and their lengths."""

    def __init__(self, ranks_a: str, json_a: str, model_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_a, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_a = json_a
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.parted = not any("▁" in p.lstrip("▁") for p in pieces)  # no piece reaches over a space
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [b"%d%c" % (i, sep) for sep in b",|;" for i in range(n)]  # an id and what follows it
        self.n_written = n

    @cached_property
    def slow_a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.json_a)
        found.encode_special_tokens = True
        return found

    def encode_a(self, text: str) -> list[int]:
        if _LONG_RUN.search(text):
            return self.slow_a.encode(" " + text, add_special_tokens=False).ids
        return self.a.encode_ordinary(" " + text)

    def parts(self, text: bytes) -> list[str]:
        """``text`` in parts that can be tokenized one by one, the space between two of them taken out."""
        cuts, at = [0], _PART
        while self.parted and at < len(text) and (m := _SAFE_CUT.search(text, at)):
            cuts.append(m.start() + 2)
            at = m.start() + _PART
        ends = [c - 1 for c in cuts[1:]] + [len(text)]
        return [text[a:b].decode() for a, b in zip(cuts, ends, strict=True)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Ids of A and of B of all texts and how many each text has, none where one of the two does not spell space + text."""
        parts, ends = [], []
        for t in texts:
            try:
                parts += self.parts(t) if t else []
            except UnicodeDecodeError:  # A would spell something else
                pass
            ends.append(len(parts))
        a, b = [self.encode_a(p) for p in parts], self.b.encode(parts, num_threads=1)
        for lo, hi, text in zip([0, *ends], ends, texts, strict=False):
            # entries of A stand for every byte, so A spells whatever is UTF-8
            if hi > lo and b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(b[lo:hi]))) != b" " + text:
                a[lo:hi], b[lo:hi] = [()] * (hi - lo), [()] * (hi - lo)
        out = []
        for ids in (a, b):
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            out += [np.fromiter(chain.from_iterable(ids), np.int32, lengths.sum()), np.diff(np.cumsum(np.append(0, lengths))[[0, *ends]])]
        return tuple(out)


_WORKER: dict[tuple[str, str, str], Tokenizers] = {}


def tokenizers(files: tuple[str, str, str]) -> Tokenizers:
    """This worker's pair of tokenizers."""
    if files not in _WORKER:
        _WORKER[files] = Tokenizers(*files)
    return _WORKER[files]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, i: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """``link_a, link_b, cut_a, cut_b`` of token streams that end at the given bytes.

    ``i`` are the A tokens where pointer pairs start, ``stop`` the A tokens that they do not
    reach.  Links and cuts come in the order of the steps.
    """
    starts = np.append(0, ends_a[:-1])[i] if len(i) else i
    j = np.searchsorted(ends_b, starts, side="right")
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(i):
        link_a.append(i)
        link_b.append(j)
        a, b = ends_a[i], ends_b[j]
        both = a == b
        cut_a.append(i[both])
        cut_b.append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (link_a, link_b, cut_a, cut_b))


class Aligned:
    """The aligned tokens of some texts; positions count through all of them."""

    def __init__(self, texts: list[bytes], tok: Tokenizers):
        self.tok = tok
        self.a, self.n_a, self.b, self.n_b = tok.encode(texts)
        self.first_a, self.first_b = (np.cumsum(np.append(0, n)) for n in (self.n_a, self.n_b))
        lanes = -(-self.n_a // LANE)
        step = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = np.repeat(self.first_a[:-1], lanes) + step * LANE
        stop = np.minimum(start + LANE, np.repeat(self.first_a[1:], lanes))
        self.link_a, self.link_b, cut_a, cut_b = lockstep(np.cumsum(tok.a_length[self.a]), np.cumsum(tok.b_length[self.b]), start, stop)
        self.cut_a, self.cut_b = np.sort(cut_a), np.sort(cut_b)  # both grow along a document
        self.owner = np.repeat(np.arange(len(texts)), self.n_a)  # of A tokens

    @cached_property
    def n_links(self) -> np.ndarray:
        return np.bincount(self.owner[self.link_a], minlength=len(self.n_a))

    @cached_property
    def n_groups(self) -> np.ndarray:
        return np.bincount(self.owner[self.cut_a], minlength=len(self.n_a))

    def groups(self) -> Iterator[bytes]:
        """Each text's groups written out: ``a1,a2|b1;a3|b2,b3``."""
        n, total = self.tok.n_written, len(self.a) + len(self.b)
        code = np.zeros(total, np.int32)
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.cut_a] = True
        last_b[self.cut_b] = True
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))  # the group of each token
        before_b = np.append(0, self.cut_b + 1)  # B tokens before a group
        code[np.arange(len(self.a)) + before_b[group_a]] = self.a + n * last_a
        code[np.arange(len(self.b)) + (self.cut_a + 1)[group_b]] = self.b + 2 * n * last_b
        edges = self.first_a + self.first_b
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            yield b"".join(map(self.tok.written.__getitem__, code[lo:hi].tolist()))[:-1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, pair, number)``: the distinct linked id pairs of each text, in order."""
        size = len(self.tok.a_bytes) * len(self.tok.b_bytes)
        code = self.a[self.link_a].astype(np.int64) * len(self.tok.b_bytes) + self.b[self.link_b]
        key = np.sort(self.owner[self.link_a] * np.int64(size) + code)
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
        return key[at] // size, key[at] % size, np.diff(np.append(at, len(key)))


def _files() -> tuple[str, str, str]:
    return vocabulary_path(RANKS_A), vocabulary_path(JSON_A), vocabulary_path(MODEL_B)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str, str] | None = None) -> DataFrame:
    """Tokens, links and cuts of every row; positions count from 0 in the row, a cut names the last tokens of a group."""
    files = files or _files()
    names = ("a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b")
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_list(batch.column(1))
            for lo, hi in chunks(texts, CHUNK_BYTES):
                x = Aligned(texts[lo:hi], tokenizers(files))
                order = np.argsort(x.link_a + x.link_b, kind="stable")  # every step adds one or two, so the sum tells the order
                link_a, link_b = x.link_a[order], x.link_b[order]
                links, cuts = np.cumsum(np.append(0, x.n_links)), np.cumsum(np.append(0, x.n_groups))
                at_a, at_b = np.repeat(x.first_a[:-1], x.n_links), np.repeat(x.first_b[:-1], x.n_links)
                cut_a, cut_b = x.cut_a - np.repeat(x.first_a[:-1], x.n_groups), x.cut_b - np.repeat(x.first_b[:-1], x.n_groups)
                lists = [(x.first_a, x.a), (x.first_b, x.b), (links, link_a - at_a), (links, link_b - at_b), (cuts, cut_a), (cuts, cut_b)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v, pa.int32())).cast(ints) for e, v in lists)],
                    names=["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(released(run), "doc_id long, " + ", ".join(f"{c} array<int>" for c in names))


_CHUNK_SCHEMA = ("chunk long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in _LONGS)
                 + ", groups_sha256 array<string>, ends array<int>, places binary, numbers binary, pairs array<long>, counts array<long>")


def _chunked(files: tuple[str, str, str]):
    """mapInArrow over ``(doc_id, text)``: one row per chunk of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), binary_list(batch.column(1))
            for lo, hi in chunks(texts, CHUNK_BYTES):
                x = Aligned(texts[lo:hi], tokenizers(files))
                hashes = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(x.groups(), x.n_a, strict=True)]
                owner, pair, number = x.pairs()
                pairs = np.sort(pair)
                pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
                place = np.searchsorted(pairs, pair)
                counts = np.bincount(place, number, len(pairs)).astype(np.int64)
                ends = np.searchsorted(owner, np.arange(hi - lo), side="right")
                lists = [ids.slice(lo, hi - lo), *(pa.array(getattr(x, c), pa.int64()) for c in _LONGS), pa.array(hashes, pa.string()),
                         pa.array(ends, pa.int32())]
                blobs = [pa.array([v.astype(np.int32).tobytes()], pa.binary()) for v in (place, number)]
                one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in [*lists, pa.array(pairs, pa.int64()), pa.array(counts, pa.int64())]]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *one[:-2], *blobs, *one[-2:]],
                                                 names=["chunk", "doc_id", *_LONGS, "groups_sha256", "ends", "places", "numbers", "pairs", "counts"])
                chunk += 1

    return run


_RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _with_totals(chunk: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of one chunk, with the totals of its pairs."""
    row = {c: chunk.column(c).combine_chunks() for c in chunk.column_names}
    order = np.argsort(totals.column("pair").to_numpy())
    total, best = (totals.column(c).to_numpy()[order].astype(np.int64) for c in ("total", "best"))
    place, number = (np.frombuffer(row[c][0].as_buffer(), np.int32) for c in ("places", "numbers"))
    edges = np.append(0, row["ends"].flatten().to_numpy())

    def per_document(x: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(x * number))[edges])

    if len(total):
        sums = [pa.array(per_document(v), pa.int64()) for v in (best[place], total[place])]
    else:
        sums = [pa.array(np.zeros(len(edges) - 1, np.int64))] * 2
    names = [f.split()[0] for f in _RESULT_SCHEMA.split(", ")]
    columns = [row["doc_id"].flatten(), *(row[c].flatten() for c in _LONGS), *sums, row["groups_sha256"].flatten()]
    return pa.Table.from_arrays(columns, names=names)


def alignment_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per document: sizes of its alignment, how its links stand in the corpus-wide counts, and a digest of its groups."""
    files = files or _files()
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    done = materialize(rows.mapInArrow(released(_chunked(files)), _CHUNK_SCHEMA), "alignment-chunks", "zstd")
    found = done.select("chunk", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("chunk", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("number"))
    totals = materialize(found.groupBy("pair").agg(F.sum("number").alias("total")), "alignment-totals", "zstd")
    b = F.pmod("pair", F.lit(len(tokenizers(files).b_bytes)))
    highest = totals.groupBy(b.alias("b")).agg(F.max("total").alias("highest"))  # one row per entry of B's vocabulary
    judged = totals.withColumn("b", b).join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = found.select(F.col("chunk").alias("of"), "pair").join(judged, "pair").select("of", "pair", "total", "best")
    return (done.drop("pairs", "counts").groupBy("chunk").cogroup(back.groupBy("of"))
            .applyInArrow(_with_totals, _RESULT_SCHEMA))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, aligned between the two vocabularies."""
    return alignment_counts(table(spark, sf_dir, "documents"))
