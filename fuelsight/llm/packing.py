"""Packing token ids into windows by minimum bin slack.

Each task tokenizes its documents and packs them by itself, so nothing is
shuffled.  Whole windows are cut off long documents; what remains of each
document goes to a pool.  A window takes the longest piece of the pool, and a
bitset subset-sum program over the multiset of piece lengths finds the sum
closest to the rest of the window; walking back through the program gives how
many pieces of each length to take, and the same multiset is used again while
the pool has it.  What is still free is filled with the head of one more
piece.  A task's last tokens form windows whose lengths are powers of two, so
no window needs padding.

A pool holds at most ``POOL_TOKENS`` (plus one batch), so memory does not grow
with a partition.  A repeated task gives the same windows again.

Defined cases: a null text counts as empty and still gives the end id; rows
that repeat a document are packed each; a null id is kept; an empty table gives
no pieces; other columns are not carried.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fuelsight.llm.common import binary_list, chunks, released, table
from fuelsight.llm.subwords import subwords, vocabulary_path

CAPACITY = 4096
END_ID = 2
POOL_TOKENS = 1 << 20


def best_fill(counts: dict[int, int], capacity: int, order: list[int] | None = None) -> dict[int, int]:
    """How many pieces of each length come closest to ``capacity`` from below; ``order`` has the lengths, ascending.

    ``reach`` has bit ``s`` set if some taken pieces sum up to ``s``; a length
    with ``c`` pieces enters as 1, 2, 4, ... pieces at once (binary splitting).
    """
    reach, steps, mask, goal = 1, [], (1 << (capacity + 1)) - 1, 1 << capacity
    order = sorted(counts) if order is None else order
    for i in range(bisect_right(order, capacity) - 1, -1, -1):
        length = order[i]
        left, k = min(counts.get(length, 0), capacity // length), 1
        while left and not reach & goal:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left -= k
            k *= 2
        if reach & goal:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + k
            total -= length * k
    return taken


class Packer:
    """Pieces wait here by length; ``windows`` are lists of pieces (doc, start, ids, doc_tokens)."""

    def __init__(self, capacity: int):
        self.capacity, self.pool, self.counts, self.order, self.tokens = capacity, {}, {}, [], 0

    def add(self, doc, ids: np.ndarray):
        """Whole windows of a document; the rest of it waits."""
        n, c = len(ids), self.capacity
        for at in range(0, n - c + 1, c):
            yield [(doc, at, ids[at : at + c].tobytes(), n)]
        if n % c:
            self._put((doc, n - n % c, ids[n - n % c :].tobytes(), n))

    def _put(self, piece) -> None:
        length = len(piece[2]) // 4
        if length not in self.pool:
            self.pool[length] = []
            insort(self.order, length)
        self.pool[length].append(piece)
        self.counts[length] = len(self.pool[length])
        self.tokens += length

    def _take(self, length: int):
        pieces = self.pool[length]
        piece = pieces.pop()
        self.counts[length] = len(pieces)
        if not pieces:
            del self.pool[length], self.counts[length], self.order[bisect_left(self.order, length)]
        self.tokens -= length
        return piece

    def _cut(self, room: int):
        """The head of the longest piece that waits; its tail waits on."""
        doc, start, ids, n = self._take(self.order[-1])
        if len(ids) > 4 * room:
            self._put((doc, start + room, ids[4 * room :], n))
        return doc, start, ids[: 4 * room], n

    def drain(self, keep: int):
        """Full windows until at most ``keep`` tokens wait (never fewer than a window's)."""
        while self.tokens >= max(keep, self.capacity):
            longest = self.order[-1]
            self.counts[longest] -= 1
            taken = best_fill(self.counts, self.capacity - longest, self.order)
            self.counts[longest] += 1
            taken[longest] = taken.get(longest, 0) + 1
            slack = self.capacity - sum(x * k for x, k in taken.items())
            for _ in range(1 if slack else min(len(self.pool[x]) // k for x, k in taken.items())):
                window = [self._take(x) for x, k in sorted(taken.items(), reverse=True) for _ in range(k)]
                room = slack
                while room:
                    window.append(self._cut(room))
                    room -= len(window[-1][2]) // 4
                yield window

    def rest(self):
        """All that waits, in windows whose lengths are powers of two."""
        yield from self.drain(0)
        while self.tokens:
            room, window = 1 << (self.tokens.bit_length() - 1), []
            while room:
                window.append(self._cut(room))
                room -= len(window[-1][2]) // 4
            yield window


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         vocabulary: str | None = None, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per piece: its document, place and ids (unsigned little-endian 32-bit), and its window and place there."""
    path = vocabulary or vocabulary_path()
    schema = T.StructType([
        docs.schema[id_col], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    doc_type = docs.select(id_col).limit(0).toArrow().schema.field(0).type

    def run(batches):
        encoder, packer = subwords(path), Packer(capacity)
        base, n = TaskContext.get().partitionId() << 36, 0

        def rows(windows, least=256):
            nonlocal n
            out = []
            for window in windows:
                at = 0
                for doc, start, ids, total in window:
                    out.append((doc, start, len(ids) // 4, total, base + n, at, ids))
                    at += len(ids) // 4
                n += 1
                if len(out) >= least:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

        def batch(rows):
            types = [doc_type, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=schema.names)

        for b in batches:
            texts, ids = binary_list(b.column(text_col)), b.column(id_col).to_pylist()
            for i, j in chunks(texts):
                flat, lengths = encoder.ids(texts[i:j])
                ends = np.cumsum(lengths)
                yield from rows(w for k in range(j - i) for w in packer.add(
                    ids[i + k], np.append(flat[ends[k] - lengths[k] : ends[k]], np.uint32(end_id)).astype("<u4")))
                if packer.tokens > pool_tokens:
                    yield from rows(packer.drain(pool_tokens // 2))
        yield from rows(packer.rest())

    return docs.select(id_col, text_col).mapInArrow(released(run), schema)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens, ids given as a checksum."""
    return digest(pack(table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
