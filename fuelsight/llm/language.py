"""Language of web pages by Bayesian fusion of several kinds of evidence.

The languages are those of the labelled documents.  For a page::

    log P(l | page) = text(l) + log P(declared | l) + log P(address | l) + log P(l | host)

* ``text``: a naive Bayes model of hashed byte trigrams, counted over all labelled
  documents; neighbouring trigrams are far from independent, so a text weighs
  as ``TEXT_GRAMS`` of its trigrams at most.
* ``declared``: the primary subtag that the markup states (``lang`` of html, content-language or og:locale).
* ``address``: the top-level domain and a language code as a path segment.
* ``host``: how the host's other pages divide, smoothed by those of its domain, which are smoothed by all pages.

How often a declaration or an address stands with a language, and how hosts and
domains divide, are sums of the text model's probabilities by grouped
aggregates; a page's own share is taken out of its host's and domain's sums.
Evidence that a page lacks says nothing.

Tables: trigram counts have ``FEATURES`` rows per language, and there may be
``MAX_LANGUAGES``; everything else stays distributed.  A host with a third of all
pages is summed up before the shuffle, and its pages are joined with one row
(split by the adaptive skew join).

Defined cases: null html or url give no evidence; a page is scanned in linear time, whatever is left open in it; without any evidence the prior
over all pages decides (ties: the first language by name); repeated rows count each; without labelled documents
the language is null; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import binary_list, chunks, materialize, released, table

FEATURES = 1 << 14
MAX_LANGUAGES = 64
TEXT_GRAMS = 30
#: Pseudo counts of smoothing: trigrams, declarations and addresses, host by domain, domain by all.
GRAM_PRIOR, VALUE_PRIOR, HOST_PRIOR, DOMAIN_PRIOR = 0.5, 1.0, 3.0, 3.0

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_OPENS = re.compile(rb"(?i)<(script|style|noscript|template)\b")
_CLOSES = {name: re.compile(rb"(?i)</" + name + rb"\s*>") for name in (b"script", b"style", b"noscript", b"template")}
_HTML, _META = re.compile(rb"(?i)<html\b"), re.compile(rb"(?i)<meta\b")
_LANG = re.compile(rb"""(?i)\blang\s*=\s*["']?([a-z]{2,3})\b""")
_STATES = re.compile(rb"""(?i)(?:content-language|og:locale)["']""")
_CONTENT = re.compile(rb"""(?i)content\s*=\s*["']?([a-z]{2,3})\b""")
_SEGMENT = re.compile(r"^/([a-z]{2,3})(?:[-_][a-zA-Z]{2,4})?(?:/|$)")


def grams(text: bytes) -> np.ndarray:
    """Feature numbers of a text's byte trigrams; anything but letters counts as one space."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def visible(page: bytes) -> bytes:
    """The text of a page: no scripts, styles, comments and tags; entities resolved.

    One pass from ``<`` to ``<``.  What is looked for once and never found is not looked for again, so the time
    is linear in the page.  An element or comment without an end is taken as a tag, a tag without an end as text.
    """
    out, at, missing = [], 0, set()

    def end_of(what: bytes, start: int) -> int:
        """Where the first ``what`` (an element's name, or plain bytes) after ``start`` ends, or -1."""
        if what in missing:
            return -1
        if what in _CLOSES:
            found = _CLOSES[what].search(page, start)
            end = found.end() if found else -1
        else:
            end = page.find(what, start)
            end += len(what) if end >= 0 else 0
        if end < 0:
            missing.add(what)
        return end

    while (start := page.find(b"<", at)) >= 0:
        end, hides = -1, _OPENS.match(page, start)
        if hides:
            end = end_of(hides[1].lower(), start)
        elif page.startswith(b"<!--", start):
            end = end_of(b"-->", start + 4)
        if end < 0:
            end = end_of(b">", start + 1)
        if end < 0:
            break
        out.append(page[at:start])
        at = end
    text = b" ".join([*out, page[at:]])
    return entities.unescape(text.decode("utf-8", "replace")).encode() if b"&" in text else text


def _tags(page: bytes, name: re.Pattern):
    """First and last position of each tag; one without an end goes to the end of the page."""
    found = name.search(page)
    while found:
        end = page.find(b">", found.end())
        yield found.end(), len(page) if end < 0 else end
        found = name.search(page, end) if end >= 0 else None


def declared(page: bytes) -> str | None:
    for start, end in _tags(page, _HTML):
        if found := _LANG.search(page, start, end):
            return found[1].decode().lower()
    for start, end in _tags(page, _META):
        states = _STATES.search(page, start, end)
        if states and (found := _CONTENT.search(page, states.end(), end)):
            return found[1].decode().lower()
    return None


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, domain (its last two labels) and the suffix with the path's language code."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").lower()
    except ValueError:
        return None, None, None
    if not host:
        return None, None, None
    labels = host.split(".")
    code = _SEGMENT.match(parts.path or "")
    return host, ".".join(labels[-2:]), f"{labels[-1]}/{code[1] if code else ''}"


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages and the log probabilities of the features in each."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column("lang").to_pylist(), binary_list(b.column("body"))
            for i, j in chunks(texts):
                by: dict[str, list[bytes]] = {}
                for lang, t in zip(langs[i:j], texts[i:j], strict=True):
                    by.setdefault(lang, []).append(t)
                for lang, some in by.items():
                    n = np.bincount(grams(b" ".join(some)), minlength=FEATURES)
                    total[lang] = total.get(lang, 0) + n
                if len(total) > MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for lang, n in total.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(n[used], pa.int64())], names=["lang", "feature", "n"])

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("body")).filter("lang is not null")
    sums = labelled.mapInArrow(released(count), "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "trigrams")
    langs = sorted(r.lang for r in sums.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts, rows = np.zeros((FEATURES, len(langs))), sums.toArrow()
    counts[rows.column("feature").to_numpy(), [langs.index(x) for x in rows.column("lang").to_pylist()]] = rows.column("n").to_numpy()
    return langs, np.log((counts + GRAM_PRIOR) / (counts.sum(0) + GRAM_PRIOR * FEATURES))


def evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """Per page: id, declaration, host, domain, address and the text's log likelihoods (an array in the order of ``langs``)."""
    logs = pages.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def work(batches):
        for b in batches:
            out = []
            for url, page in zip(b.column("url").to_pylist(), binary_list(b.column("html")), strict=True):
                g = grams(visible(page))
                if len(g):
                    n = np.bincount(g, minlength=FEATURES)
                    used = np.flatnonzero(n)
                    text = (n[used] @ logs.value[used].astype(np.float64)) * (min(TEXT_GRAMS, len(g)) / len(g))
                else:
                    text = np.zeros(len(langs))
                out.append((declared(page), *address(url), text.tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [*[pa.string()] * 4, pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                             names=["page_id", "declared", "host", "domain", "address", "text"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return slim.mapInArrow(released(work), "page_id long, declared string, host string, domain string, address string, text array<double>")


def _softmax(logs: Column) -> Column:
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(weights, lambda x: x / F.aggregate(weights, F.lit(0.0), lambda a, y: a + y))


def fuse(found: DataFrame, langs: list[str]) -> DataFrame:
    """Language and probability of each page from ``evidence``."""
    k = len(langs)
    rows = found.withColumn("share", _softmax(F.col("text")))
    sums = [F.sum(F.col("share")[i]).alias(f"s{i}") for i in range(k)]
    vector = F.array(*[F.col(f"s{i}") for i in range(k)])
    total = rows.agg(*[F.coalesce(s, F.lit(0.0)) for s in sums]).first()  # one number per language
    everywhere = F.array(*[F.lit(float(x)) for x in total])
    for name in ("declared", "address", "host", "domain"):
        by = rows.filter(F.col(name).isNotNull()).groupBy(name).agg(*sums).select(name, vector.alias(f"by_{name}"))
        rows = rows.join(by, name, "left")
    values = {name: rows.filter(F.col(name).isNotNull()).agg(F.count_distinct(name)).first()[0] + 1 for name in ("declared", "address")}
    rows = rows.withColumn("all", everywhere)

    def stands_with(name: str) -> Column:
        """log P(value | l), up to a constant where there is no value."""
        each = F.transform(F.col(f"by_{name}"), lambda x, i: F.log((x - F.get("share", i) + VALUE_PRIOR) / (F.get("all", i) + VALUE_PRIOR * values[name])))
        return F.when(F.col(name).isNull(), F.transform("share", lambda x: F.lit(0.0))).otherwise(each)

    plus = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    others = lambda name: F.when(F.col(name).isNull(), F.transform("share", lambda x: F.lit(0.0))).otherwise(
        F.zip_with(f"by_{name}", "share", lambda x, y: F.greatest(x - y, F.lit(0.0))))
    rows = rows.withColumn("of_all", F.transform("all", lambda x: (x + 1.0) / (plus(F.col("all")) + k)))
    for name, prior, below in (("domain", DOMAIN_PRIOR, "of_all"), ("host", HOST_PRIOR, "of_domain")):
        rows = rows.withColumn("n", others(name))
        rows = rows.withColumn(f"of_{name}", _blend(F.col("n"), F.col(below), prior, plus))
    both = F.zip_with(stands_with("declared"), stands_with("address"), lambda x, y: x + y)
    both = F.zip_with(both, "text", lambda x, y: x + y)
    logs = F.zip_with(both, "of_host", lambda x, y: x + F.log(y))
    names = F.array(*[F.lit(x) for x in langs])
    rows = rows.withColumn("p", _softmax(logs)).withColumn("at", F.array_position("p", F.array_max("p")).cast("int"))
    text = F.array_position("share", F.array_max("share")).cast("int")
    return rows.select("page_id", F.get(names, F.col("at") - 1).alias("lang"), F.get("p", F.col("at") - 1).alias("probability"),
                       F.get(names, text - 1).alias("text_lang"), "declared", "host")


def _blend(counts: Column, below: Column, prior: float, plus) -> Column:
    return F.zip_with(counts, below, lambda x, y: (x + prior * y) / (plus(counts) + prior))


def identify(pages: DataFrame, docs: DataFrame, **names) -> DataFrame:
    """Language of every page, with the text model from the labelled documents."""
    langs, model = train(docs, **names)
    if not langs:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"))])
    return fuse(materialize(evidence(pages, langs, model), "evidence"), langs)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all pages."""
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
