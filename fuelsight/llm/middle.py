"""Fill-in-the-middle: documents whose middle is moved behind its sentinel, and back.

A text is cut at two code points into prefix, middle and suffix.  Sentinels are
put in at the cuts in a bytearray, in reading order, and the segments change
places inside it by a rotation made of three reversals (both parts, then the
whole), so no second copy of the text is put together.  Bytes are reversed,
never characters, and reversed again, so UTF-8 survives.  :func:`restore` finds
the sentinels in an output, rotates the other way and takes them out again; it
needs the output and the form, nothing else.

The cuts and the form follow from a SHA-256 of ``1:`` and the decimal id, so a
repeated task gives the same rows.  Nothing is shuffled, and a task holds one
piece of a batch (4 MB of texts, or one longer text) at a time.

Defined cases: a null or empty text and a text that holds a sentinel itself stay
plain, as nothing could be told apart in them; a null id is hashed as no digits;
rows that repeat an id are cut alike; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import binary_list, chunks, released, table

PREFIX, MIDDLE, SUFFIX = b"<P>", b"<M>", b"<S>"
PLAIN_FROM = 90  # of 100: the documents that stay as they are
SPM_BELOW = 20  # of 100: suffix first

_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                  ("middle_chars", pa.int64()), ("output", pa.binary())])
_OUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Reverses ``view[a:b]`` where it stands; only half of it is held besides."""
    half = (b - a) // 2
    head = view[a : a + half].copy()
    view[a : a + half] = view[b - half : b][::-1]
    view[b - half : b] = head[::-1]


def rotate(view: np.ndarray, a: int, m: int, b: int) -> None:
    """Exchanges the neighbours ``view[a:m]`` and ``view[m:b]`` in place."""
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide a document."""
    h = hashlib.sha256(b"1:%s" % (b"" if doc_id is None else b"%d" % doc_id)).hexdigest()
    return [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]


def code_points(text: bytes) -> np.ndarray:
    """Where each code point begins, and the end."""
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(text))


def plan(doc_id: int | None, text: bytes, n: int) -> tuple[str, int, int]:
    """Form and cuts (in code points) of a document of ``n`` code points."""
    h1, h2, h3, h4 = draws(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), a, b


def rearrange(text: bytes, form: str, a: int, b: int) -> bytearray:
    """``text`` with its segments in the order of ``form``; ``a`` and ``b`` are byte positions."""
    out = bytearray(text)
    if form == "plain":
        return out
    out[b:b] = SUFFIX
    out[a:a] = MIDDLE
    out[0:0] = PREFIX
    view = np.frombuffer(out, np.uint8)
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    rotate(view, 0 if form == "spm" else middle, suffix, len(out))
    return out


def rebuild(output: bytes, form: str) -> bytearray:
    """The text that :func:`rearrange` was given."""
    text = bytearray(output)
    if form == "plain":
        return text
    view = np.frombuffer(text, np.uint8)
    n = len(text)
    if form == "spm":  # suffix, then prefix and middle
        prefix = text.index(PREFIX)
        rotate(view, 0, prefix, n)
        middle, suffix = text.index(MIDDLE), n - prefix
    else:  # prefix, suffix, middle
        middle = text.index(SUFFIX)
        moved = text.index(MIDDLE)
        rotate(view, middle, moved, n)
        suffix = middle + n - moved
    del view  # a bytearray that is looked at cannot shrink
    del text[suffix : suffix + len(SUFFIX)], text[middle : middle + len(MIDDLE)], text[: len(PREFIX)]
    return text


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), binary_list(batch.column(1))
        for lo, hi in chunks(texts):
            rows = []
            for doc_id, text in zip(ids[lo:hi], texts[lo:hi], strict=True):
                at = code_points(text)
                n = len(at) - 1
                form, a, b = plan(doc_id, text, n)
                cut = (None, None) if form == "plain" else (a, b - a)
                rows.append((doc_id, n, form, *cut, bytes(rearrange(text, form, int(at[a]), int(at[b])))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every row."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(released(_transform), _OUT_SCHEMA).withColumn("output", F.col("output").cast("string"))


def restore(outputs: DataFrame) -> DataFrame:
    """The columns of ``outputs`` and ``restored``, the text rebuilt from ``output`` and ``form``."""
    kept = [c for c in outputs.columns if c != "restored"]
    form, output = kept.index("form"), kept.index("output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, texts = batch.column(form).to_pylist(), binary_list(batch.column(output))
            for lo, hi in chunks(texts):
                back = [bytes(rebuild(t, f)) for t, f in zip(texts[lo:hi], forms[lo:hi], strict=True)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.binary())], names=[*kept, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.select(kept).schema) + ", restored binary"
    return outputs.select(kept).mapInArrow(released(run), schema).withColumn("restored", F.col("restored").cast("string"))


def digest(rows: DataFrame) -> DataFrame:
    """The columns of the query: texts as SHA-256 of their UTF-8 bytes."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, rearranged and rebuilt."""
    return digest(restore(transform(table(spark, sf_dir, "documents"))))


ORACLE = """
WITH texts AS (SELECT doc_id, coalesce("text", '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM texts),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts
"""
