"""Benchmark decontamination with training suffix arrays.

Each task turns its documents, a few megabytes at a time (a shard), into word
numbers of the benchmark vocabulary and sorts the suffixes that can match: a
position enters the shard's suffix array if the shortest window fits into
benchmark words there.  Every test suffix is then binary-searched in the
array; the range it finds gives all places of its window, and the matches
that cannot be extended to the left are extended to the right for the longest
verbatim match.  Nothing is shuffled.

The benchmark travels to the tasks by broadcast.  It is dealt into blocks of
about ``BLOCK_BYTES`` of text by a hash of the item, one job per block, so that
a broadcast does not grow with the benchmark (an item is never cut).  Between
blocks the documents' state is written to the shared folder.

Defined cases: null or empty texts have no words and are never contaminated;
items without words match nothing; rows that repeat an item or its id count as
one item in ``n_items``; an item with a null id is listed as ``null``; repeated
documents are judged row by row; an empty benchmark or documents table gives
no hits or no rows; columns of the documents, whatever their names, pass through
``remove`` unchanged.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fuelsight.llm.common import binary_list, chunks, materialize, released, table

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: A document is contaminated from one hit word in this many on.
RATIO = 20

_SPLIT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_words", T.LongType()),
    T.StructField("longest_start", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_item_start", T.LongType()),
])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("longest_words", pa.int64()),
    ("longest_start", pa.int64()), ("longest_item", pa.string()), ("longest_item_start", pa.int64()),
])


def split_words(text: bytes) -> list[bytes]:
    """ASCII letters and digits in lower case and all other code points from U+0080 on."""
    return text.lower().translate(_SPLIT).split()


class Suffixes:
    """The windows of one benchmark block: one entry per distinct word sequence, with the places where it stands."""

    def __init__(self, rows: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[str, list[int]]] = []
        places: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in sorted({(label, text or "") for label, text in rows}):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in split_words(text.encode())]
            if not ids:
                continue
            k, packed = len(self.items), np.array(ids, ">u4").tobytes()
            self.items.append((label, ids))
            length = min(window, len(ids))
            for j in range(len(ids) - length + 1):
                places.setdefault(packed[4 * j : 4 * (j + length)], []).append((k, j))
        self.keys = sorted(places)
        self.places = [places[x] for x in self.keys]
        self.shortest = min((len(x) // 4 for x in self.keys), default=window)
        self.depth = 4 * window


def _match(texts: list[bytes], test: Suffixes) -> list[dict]:
    """State of each document of one shard."""
    known, first, n_words = [], [0], []
    for t in texts:
        words = split_words(t)
        n_words.append(len(words))
        known.append(np.fromiter(map(test.vocabulary.get, words, [0] * len(words)), np.uint32, len(words)))
        known.append(np.zeros(1, np.uint32))  # ends the document: matches no test word
        first.append(first[-1] + len(words) + 1)
    ids = np.concatenate(known + [np.zeros(test.depth // 4, np.uint32)])
    run = np.cumsum(ids > 0)
    width = test.shortest
    whole = run[width - 1 :] - np.concatenate([[0], run[:-width]]) == width
    places = np.flatnonzero(whole)
    out = [{"n_words": n, "spans": [], "items": set(), "best": None} for n in n_words]
    if not len(places) or not test.keys:
        return out
    packed, at = ids.astype(">u4").tobytes(), places.tolist()
    order = sorted((packed[4 * p : 4 * p + test.depth], p) for p in at)  # the suffix array
    suffixes = [x for x, _ in order]
    hits: list[tuple[int, int, int]] = []
    heads = set(ids[places].tolist())
    for w, key in enumerate(test.keys):
        if int.from_bytes(key[:4], "big") not in heads:
            continue
        low = bisect_left(suffixes, key)
        high = bisect_left(suffixes, key + b"\xff\xff\xff\xff", low)
        hits += [(order[i][1], len(key) // 4, w) for i in range(low, high)]
    if not hits:
        return out
    hits.sort()
    doc_of = np.searchsorted(first, [p for p, _, _ in hits], side="right") - 1
    numbers = ids.tolist()
    for d, (p, length, w) in zip(doc_of.tolist(), hits, strict=True):
        state, begin = out[d], first[d]
        spans = state["spans"]
        if spans and p - begin <= spans[-1]:
            spans[-1] = max(spans[-1], p - begin + length)
        else:
            spans += [p - begin, p - begin + length]
        for k, j in test.places[w]:
            label, item = test.items[k]
            state["items"].add(label)
            if j and item[j - 1] == numbers[p - 1] and p > begin:
                continue  # part of a match that began further left
            n, most = length, len(item) - j
            while n < most and item[j + n] == numbers[p + n]:
                n += 1
            best = (-n, p - begin, label, j)
            if state["best"] is None or best < state["best"]:
                state["best"] = best
    return out


def _merge(old: dict, new: dict) -> dict:
    """Union of what two benchmark blocks found in one document."""
    spans: list[int] = []
    for s, e in sorted(zip(old["spans"][::2] + new["spans"][::2], old["spans"][1::2] + new["spans"][1::2], strict=True)):
        if spans and s <= spans[-1]:
            spans[-1] = max(spans[-1], e)
        else:
            spans += [s, e]
    best = min((b for b in (old["best"], new["best"]) if b), default=None)
    return {"n_words": new["n_words"], "spans": spans, "items": old["items"] | new["items"], "best": best}


def _pack(state: dict) -> dict:
    n, at, label, j = state["best"] or (0, None, None, None)
    return {"n_words": state["n_words"], "spans": state["spans"], "items": sorted(state["items"]), "longest_words": -n,
            "longest_start": at, "longest_item": label, "longest_item_start": j}


def _unpack(s: dict) -> dict:
    best = (-s["longest_words"], s["longest_start"], s["longest_item"], s["longest_item_start"]) if s["longest_words"] else None
    return {"n_words": s["n_words"], "spans": list(s["spans"]), "items": set(s["items"]), "best": best}


def _pass(docs: DataFrame, test, text_col: str, state_col: str, keep: list[str]) -> DataFrame:
    """One benchmark block against all documents."""
    known = state_col in docs.columns
    schema = T.StructType([f for f in docs.schema if f.name in keep]).add(state_col, _STATE)
    order = [f.name for f in schema[:-1]]

    def run(batches):
        for b in batches:
            texts = binary_list(b.column(text_col))
            states = []
            for i, j in chunks(texts):
                states += _match(texts[i:j], test.value)
            if known:
                states = [_merge(_unpack(o), s) for o, s in zip(b.column(state_col).to_pylist(), states, strict=True)]
            made = pa.array([_pack(s) for s in states], _ARROW)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in order] + [made], names=[*order, state_col])

    return docs.mapInArrow(released(run), schema)


def annotate(docs: DataFrame, bench: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id",
             bench_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, state_col: str = "_decon") -> DataFrame:
    """``keep`` columns of every document and what the benchmark shares with it, as a struct ``state_col``.

    The struct: ``n_words``; ``spans``, starts and ends of the hit word ranges, in turn; ``items``, the ids
    found; and the longest verbatim match (its words, its place in the document, the item and the place there).
    """
    spark = docs.sparkSession
    items = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("label"), F.col(bench_text).alias("body"))
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    part = F.pmod(F.xxhash64("label", "body"), F.lit(blocks))
    for k in range(blocks):
        test = Suffixes([tuple(r) for r in items.filter(part == k).collect()], window)
        last = k == blocks - 1
        docs = _pass(docs, spark.sparkContext.broadcast(test), text_col, state_col, keep if last else [*dict.fromkeys([*keep, text_col])])
        if not last:
            docs = materialize(docs, "decontaminate")
    return docs


def _hit_words(state_col: str):
    s = F.col(f"{state_col}.spans")
    return F.aggregate(F.transform(s, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)


def report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", window: int = WINDOW, ratio: int = RATIO, **names) -> DataFrame:
    """One row per document: hit words, items found, longest match and the verdict."""
    found = annotate(docs, bench, [id_col], window=window, **names)
    s = found.select(F.col(id_col), F.col("_decon.*"), _hit_words("_decon").alias("n_hit"))
    return s.select(
        F.col(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.col("items").alias("item_ids"), ((F.col("n_hit") > 0) & (ratio * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "longest_words", "longest_start", "longest_item", "longest_item_start",
    )


def remove(docs: DataFrame, bench: DataFrame, window: int = WINDOW, ratio: int = RATIO, text_col: str = "text", **names) -> DataFrame:
    """The documents that are not contaminated, with all their columns and nothing else."""
    state = "_decon"
    while state in docs.columns:
        state += "_"
    found = annotate(docs, bench, docs.columns, text_col=text_col, window=window, state_col=state, **names)
    hit = _hit_words(state)
    return found.filter(~((hit > 0) & (ratio * hit >= F.col(f"{state}.n_words")))).select(*docs.columns)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark: hit words, items and verdict per document."""
    found = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
        "longest_words", "longest_start", "longest_item",
    )
