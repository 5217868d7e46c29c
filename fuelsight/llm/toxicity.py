"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct words, pairs of neighbours and pairs with
one word between them (ASCII lower case, ASCII punctuation parts words), each hashed to
one of ``2 ** BITS`` coordinates.  Every coordinate has its own learning rate,
``alpha / (beta + sqrt(sum of squared gradients))`` (:class:`Rates`), and the L1 term holds it at zero until
the evidence exceeds ``l1``; so a few hundred weights are left, which travel to the tasks that score.

Learning is spread: labelled rows are dealt into shards of about ``SHARD_ROWS``, each
shard goes through its rows one by one from the common state, and the states are
averaged coordinate by coordinate; ``ROUNDS`` rounds of that.  A state is 8 MB
whatever the corpus, averaged in blocks.  Positive rows weigh ``positive`` times, as they are few.

Bounds (documented parameters): about ``SAMPLE_ROWS`` labelled rows are learned from, chosen by
a hash of their ids (all of them when there are fewer); the ids and labels of that sample
are broadcast, some 2 MB.  All rows are scored, over their whole texts.

Defined cases: a label of null or of an unknown document teaches nothing; several labels of
one id count as the largest; of several texts of one id the one with the smallest hash
teaches; a null id is never held out and never teaches; a null or empty text scores the bias
alone; without a labelled row every score is 0; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import Words, binary_list, chunks, materialize, mix, released, table

BITS = 20
ROUNDS = 3
SHARD_ROWS = 16_384
SAMPLE_ROWS = 100_000
HELD_OUT_OF = 5

_BLOCK = 1 << 12
_SIZE = 1 << BITS  # the bias is one more coordinate, in a block of its own
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not (48 <= c <= 57 or 97 <= c <= 122) else c for c in range(256))
_STATE_SCHEMA = "block int, z binary, n binary"
_STATE = pa.schema([("block", pa.int32()), ("z", pa.binary()), ("n", pa.binary())])
_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


class Rates(NamedTuple):
    """What steers the learner."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 0.0
    positive: float = 2.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weights that a state stands for: zero within the L1 bound."""
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, coordinate)`` of every word, pair and skip-pair, repeats included."""
    words = Words([t.translate(_CLEAN) for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    owners, keys = [owner], [mix(words.hash)]
    for gap in (1, 2):
        same = owner[:-gap] == owner[gap:]
        pair = mix(words.hash[:-gap] * np.uint64(2 * gap + 1) + mix(words.hash[gap:] + np.uint64(gap)))
        owners.append(owner[:-gap][same])
        keys.append(pair[same])
    return np.concatenate(owners), (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct(owner: np.ndarray, coordinate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, coordinate) once, in order."""
    key = np.sort(owner << BITS | coordinate)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return key >> BITS, key & (_SIZE - 1)


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


class Ftrl:
    """State per coordinate: ``z`` (gradients, corrected for the moves made) and ``n`` (squared gradients)."""

    def __init__(self, z: np.ndarray, n: np.ndarray, rates: Rates):
        self.z, self.n, self.rates = z, n, rates

    def learn(self, at: np.ndarray, label: int) -> None:
        """One row, whose coordinates ``at`` (each once) have the value 1."""
        z, n = self.z[at], self.n[at]
        w = self.rates.weights(z, n)
        g = (probability(w.sum()) - label) * (self.rates.positive if label else 1.0)
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rates.alpha * w
        self.n[at] = n + g * g


def _unpack(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of a state as two arrays; blocks that nothing has touched are zero."""
    z, n = np.zeros(_SIZE + _BLOCK), np.zeros(_SIZE + _BLOCK)
    for block, zs, ns in zip(*(rows.column(c).to_pylist() for c in ("block", "z", "n")), strict=True):
        z[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(zs, np.float32)
        n[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(ns, np.float32)
    return z, n


def _shard_round(state, rates: Rates):
    """mapInArrow over rows ``(shard, text, toxic)`` in shard order: the state after each shard, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = model = None

        def blocks():
            touched = np.flatnonzero(model.n.reshape(-1, _BLOCK).any(axis=1))
            cut = [pa.array([a[b * _BLOCK : (b + 1) * _BLOCK].astype(np.float32).tobytes() for b in touched], pa.binary()) for a in (model.z, model.n)]
            return pa.RecordBatch.from_arrays([pa.array(touched, pa.int32()), *cut], schema=_STATE)

        for batch in batches:
            shards, labels, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist(), binary_list(batch.column(1))
            for lo, hi in chunks(texts):
                owner, at = distinct(*features(texts[lo:hi]))
                ends = np.searchsorted(owner, np.arange(hi - lo + 1))
                for i in range(lo, hi):
                    if shards[i] != shard:
                        if model is not None:
                            yield blocks()
                        shard, model = shards[i], Ftrl(*(a.copy() for a in state.value), rates)
                    model.learn(np.append(at[ends[i - lo] : ends[i - lo + 1]], _SIZE), labels[i])
        if model is not None:
            yield blocks()

    return run


def _mean_of(shards: int):
    """applyInArrow for one block: the mean of the shards' states (a shard that has not touched the block has zeros)."""

    def run(rows: pa.Table) -> pa.Table:
        mean = [sum(np.frombuffer(b, np.float32).astype(np.float64) for b in rows.column(c).to_pylist()) / shards for c in ("z", "n")]
        return pa.Table.from_arrays([rows.column("block").slice(0, 1), *(pa.array([m.astype(np.float32).tobytes()], pa.binary()) for m in mean)], schema=_STATE)

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not to be learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """``shard, text, toxic`` of the labelled rows to learn from, written once, and the number of shards."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    share = min(1.0, sample_rows / max(n, 1))
    part = 1 << 32
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(part)) < int(share * part))
    shards = max(1, round(min(n, sample_rows) / shard_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.where(~held_out()).join(F.broadcast(sample), "doc_id")  # at most about sample_rows pairs of numbers
    one = found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    rows = one.select(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), "text", "toxic",
                      F.xxhash64("doc_id", F.lit(2)).alias("turn"))
    return materialize(rows, "toxic-rows", "zstd"), shards


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS,
          rounds: int = ROUNDS, rates: Rates = Rates()) -> tuple[np.ndarray, np.ndarray, float]:
    """The model: coordinates with a weight, their weights, the bias."""
    spark = docs.sparkSession
    rows, shards = training_rows(docs, labels, sample_rows, shard_rows)
    if rows.isEmpty():
        return np.zeros(0, np.int64), np.zeros(0), -np.inf
    ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", "turn").select("shard", "text", "toxic")
    z, n = np.zeros(_SIZE + _BLOCK), np.zeros(_SIZE + _BLOCK)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))
        after = ordered.mapInArrow(released(_shard_round(state, rates)), _STATE_SCHEMA)
        z, n = _unpack(after.groupBy("block").applyInArrow(_mean_of(shards), _STATE_SCHEMA).toArrow())  # 257 rows of 32 KB
        state.destroy()
    w = rates.weights(z, n)
    kept = np.flatnonzero(w[:_SIZE])
    return kept, w[kept], float(w[_SIZE])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, values, bias = packed.value
        w = np.zeros(_SIZE)
        w[kept] = values
        for batch in batches:
            texts = binary_list(batch.column(1))
            for lo, hi in chunks(texts):
                owner, at = features(texts[lo:hi])
                telling = w[at] != 0  # few are: only these have to be made distinct
                owner, at = distinct(owner[telling], at[telling])
                margin = bias + np.bincount(owner, w[at], hi - lo)
                p = probability(margin) if np.isfinite(bias) else np.zeros(hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(p, pa.float64())], schema=_SCORE)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(released(run), "doc_id long, score double")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; nothing but texts goes into a score."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
