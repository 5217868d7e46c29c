"""Helpers shared by the corpus operators: tables, scratch tables, word splitting and hashing.

Text is handled as UTF-8 bytes inside tasks.  ``bytes.split()`` without
arguments splits at exactly the characters ``[\\x20\\x09-\\x0D]``, so it yields
the words of that definition without a regular expression.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.session import scratch_path, shared_dir

#: Texts of one Arrow batch are worked on in pieces of about this many bytes (a longer text alone).
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    Cuts the lineage: a lost executor cannot make Spark redo what lies before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder.

    Like :func:`materialize`, but Spark can remove the files when nothing refers to
    them any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)  # names the folder where the session has none, as in tests
    return df.checkpoint()


FILTER_BITS = 1 << 20


def key_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """A test that is true for all hashes in the one (long) column of ``keys`` and for few others.

    A bitmap of fixed size, so it is small whatever the number of keys; the more there
    are, the less it spares the exact join that has to follow.
    """
    bit = F.pmod(F.col(keys.columns[0]), F.lit(FILTER_BITS))
    words = keys.select((bit / 64).cast("long").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({keys.columns[0]}, 64) as int))").alias("b"))
    bitmap = [0] * (FILTER_BITS // 64)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():  # at most FILTER_BITS / 64 rows
        bitmap[r.w] = r.b
    packed = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")  # folded into a literal once

    def test(key: Column) -> Column:
        at = F.pmod(key, F.lit(FILTER_BITS))
        word = F.get(packed, (at / 64).cast("int"))
        return F.call_function("shiftrightunsigned", word, F.pmod(key, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one aggregate)."""
    return df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def binary_list(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def released(work):
    """``work`` for mapInArrow that gives freed memory back at its end: workers live on, and their C library keeps it."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            with contextlib.suppress(OSError, AttributeError):  # not glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    return ranges(map(len, texts), limit)


def ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """:func:`chunks` of texts of some sizes."""
    start = size = end = 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
        end = i + 1
    if start < end:
        yield start, end


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, found and hashed with array operations.

    ``start``/``end`` are byte positions in ``data`` (the texts joined by one
    space), ``first`` holds each text's first word number (one entry more than
    texts), ``hash`` a 64-bit hash per word.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.raw = b" ".join(texts) + b" "
        data = np.frombuffer(self.raw, np.uint8)
        if lower:
            data = _LOWER[data]
        self.data = data
        word = np.zeros(len(data) + 1, bool)
        np.logical_not(_SPACE[data], out=word[1:])
        self.start = np.flatnonzero(word[1:] & ~word[:-1])
        self.end = np.flatnonzero(word[:-1] & ~word[1:])
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, begin)
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Polynomial hashes of random byte values, all words at once from one running sum, then scrambled."""
        out = np.zeros(len(self.start), np.uint64)
        step = 1 << 20  # bytes a time; words that cross an edge are taken with the later piece
        powers, inverse = _powers(_BASE, step), _powers(_INVERSE, step)
        at = 0
        while at < len(self.start):
            low = int(self.start[at])
            to = max(at + 1, int(np.searchsorted(self.end, low + step, side="right")))
            high = int(self.end[to - 1])
            if high - low > step:  # a single word longer than a piece
                powers, inverse = _powers(_BASE, high - low), _powers(_INVERSE, high - low)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE[data[low:high]] * powers[: high - low], out=sums[1:])
            s, e = self.start[at:to] - low, self.end[at:to] - low
            out[at:to] = (sums[e] - sums[s]) * inverse[s]
            out[at:to] += (e - s).astype(np.uint64)
            at = to
        return mix(out)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(_BASE) + h[i : i + n]
    return mix(out)

