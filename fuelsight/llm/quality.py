"""Quality rules as weak supervision, in DataFrame expressions only.

Each rule votes good (1), bad (-1) or abstains (0).  The vote patterns of all
documents are counted by one grouped aggregate (at most ``3 ** len(RULES)``
patterns, whatever the size of the input), expectation-maximisation over that
histogram estimates how often each rule is right, and the posterior
probability of good quality is the log odds that the votes add up to.  A
document is kept from ``KEEP`` on, unless it fails the base limits.

The model has, for each rule and class, the rates of its three votes, so a rule
that says good to nearly everything counts little when it does and much when it
does not.  A Dirichlet prior in which bad votes are rarer among good documents
keeps the classes from swapping their names.

Repeated words are counted exactly: windows are compared by 64-bit hashes
first (of 2, 4, then 8 words), and only texts in which two hashes meet compare the words themselves.

Defined cases: a null or empty text has no words, fails the base limits and
gets no vote from the rules; an empty table has no patterns and gives no rows;
repeated documents are judged (and counted) row by row; ``keep`` returns the
input's columns, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import checkpointed, materialize, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP = 0.5
ROUNDS = 50
VOTES = (-1, 0, 1)
#: Where the estimation starts, and its Dirichlet prior (worth ``PRIOR`` documents of each class): the share of good
#: documents and how often a rule votes bad, abstains and votes good on good and on bad documents.
START, PRIOR = 0.8, 10.0
GOOD, BAD = {-1: 0.02, 0: 0.18, 1: 0.8}, {-1: 0.3, 0: 0.2, 1: 0.5}

_SPACE = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column, hashes: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that stand in the text twice or more; ``hashes`` are those of ``words``."""

    def covered(windows: Column) -> Column:
        tagged = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        n = F.size(windows)

        def twice(s: Column) -> Column:
            same = lambda e, j: ((j > 0) & (F.get(s, j - 1)["w"] == e["w"])) | ((j < n - 1) & (F.get(s, j + 1)["w"] == e["w"]))
            return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))

        def total(at: Column) -> Column:
            step = lambda i, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - i, F.lit(window)))
            return F.aggregate(F.transform(at, step), F.lit(0), lambda a, x: a + x)

        return _let(_let(tagged, twice), total)

    exact = _let(F.transform(F.sequence(F.lit(1), F.size(words) - window + 1), lambda i: F.array_join(F.slice(words, i, window), " ")), covered)

    def joined(keys: Column, width: int) -> Column:
        """Hashes of sequences twice as long, from those at ``width`` words' distance."""
        return F.zip_with(F.slice(keys, 1, F.size(keys) - width), F.slice(keys, width + 1, F.size(keys)), lambda x, y: F.xxhash64(x, y))

    def repeats(keys: Column) -> Column:
        return F.size(F.array_distinct(keys)) < F.size(keys)

    def test(keys: Column, width: int) -> Column:
        if width == window:
            return F.when(repeats(keys), exact).otherwise(0)
        longer = _let(joined(keys, width), lambda k: test(k, 2 * width))
        # a window that stands twice holds shorter sequences that do: where half a window never does, nothing is left to do
        return F.when(repeats(keys), longer).otherwise(0) if 2 * width == window else longer

    return F.when(F.size(words) > window, test(hashes, 1)).otherwise(0).cast("long")


def base_counts(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the struct ``_q``: the base counts and what the rules look at.  ``window`` is a power of two."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda chars: (F.length(text) - F.length(F.regexp_replace(text, chars, ""))).cast("long")
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    first = docs.select("*", F.struct(words.alias("words"), lines.alias("lines")).alias("_w"))
    first = first.withColumn("_h", F.transform(F.col("_w.words"), lambda x: F.xxhash64(x)))
    w, h = F.col("_w"), F.col("_h")
    neighbours = F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h)), lambda x, y: x == y)
    return first.withColumn("_q", F.struct(
        F.size(w["words"]).cast("long").alias("n_words"), (F.length(text).cast("long") - count(_SPACE)).alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size(w["lines"]) - F.size(F.array_distinct(w["lines"]))).cast("long").alias("n_dup_lines"),
        _repeat_words(w["words"], h, window).alias("n_repeat_words"),
        F.size(w["lines"]).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>][^\\x20\\x09-\\x0D]*")).cast("long").alias("n_symbol_words"),
        F.when(F.size(h) > 1, F.size(F.filter(neighbours, lambda x: x))).otherwise(0).cast("long").alias("n_stutter"),
        count("[0-9]").alias("n_digits"), count("[!?]").alias("n_marks"), count("\\p{Lu}").alias("n_upper"), count("\\p{L}").alias("n_letters"),
    )).drop("_w", "_h")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(q: Column) -> dict[str, Column]:
    """The rules.  Shares are compared as products of counts, so nothing divides by zero."""
    n, chars = q["n_words"], q["word_chars"]
    some = n >= 1
    rules = {
        "word_length": _vote((chars >= 3 * n) & (chars <= 12 * n), (2 * chars < 5 * n) | (chars > 20 * n)),
        "symbols": _vote(50 * q["n_symbols"] <= n, 10 * q["n_symbols"] >= n),
        "symbol_density": _vote(200 * q["n_symbols"] <= chars, 33 * q["n_symbols"] >= chars),
        "symbol_words": _vote(50 * q["n_symbol_words"] <= n, 10 * q["n_symbol_words"] >= n),
        "digits": _vote(10 * q["n_digits"] <= chars, 3 * q["n_digits"] >= chars),
        "exclamation": _vote(20 * q["n_marks"] <= n, 3 * q["n_marks"] >= n),
        "capitals": _vote(5 * q["n_upper"] <= q["n_letters"], 2 * q["n_upper"] >= q["n_letters"]),
        "letters": _vote(5 * q["n_letters"] >= 4 * chars, 3 * q["n_letters"] <= 2 * chars),
        "repeated_lines": _vote(q["n_dup_lines"] == 0, 10 * q["n_dup_lines"] >= 3 * q["n_lines"]),
        "repeated_words": _vote(20 * q["n_repeat_words"] <= n, 5 * q["n_repeat_words"] >= n),
        "stutter": _vote(50 * q["n_stutter"] <= n, 5 * q["n_stutter"] >= n),
    }
    return {k: F.when(some, v).otherwise(0) for k, v in rules.items()}


RULES = ("word_length", "symbols", "symbol_density", "symbol_words", "digits", "exclamation", "capitals", "letters", "repeated_lines",
         "repeated_words", "stutter")


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Share of good documents and, for each rule, how often good and bad documents get each vote."""
    n_rules, total = len(patterns[0][0]) if patterns else 0, sum(c for _, c in patterns)
    share, rates = START, [{v: (GOOD[v], BAD[v]) for v in VOTES} for _ in range(n_rules)]
    for _ in range(rounds if total else 0):
        sums = [{v: [PRIOR * GOOD[v], PRIOR * BAD[v]] for v in VOTES} for _ in range(n_rules)]
        good = 0.0
        for p, c in patterns:
            x = posterior(p, share, rates)
            good += c * x
            for r, v in enumerate(p):
                sums[r][v][0] += c * x
                sums[r][v][1] += c * (1 - x)
        share = (good + PRIOR * START) / (total + PRIOR)
        n_good, n_bad = good + PRIOR, total - good + PRIOR
        rates = [{v: (s[v][0] / n_good, s[v][1] / n_bad) for v in VOTES} for s in sums]
    return share, rates


def _evidence(rates: dict[int, tuple[float, float]], vote: int) -> float:
    good, bad = rates[vote]
    return math.log(good) - math.log(bad)


def posterior(pattern: tuple[int, ...], share: float, rates: list[dict[int, tuple[float, float]]]) -> float:
    z = math.log(share) - math.log(1 - share) + sum(_evidence(t, v) for t, v in zip(rates, pattern, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, keep_from: float = KEEP) -> DataFrame:
    """``keep`` columns (all), ``_q`` (counts) and ``_p`` (probability, ``base_failed`` and ``kept``).

    The counts are taken once and written, with ``keep``, to the shared folder: the rates need all of them first.
    Whole rows go there as compressed Parquet, as a checkpoint would hold their texts as they are.
    """
    counted = base_counts(docs, text_col).select(*(docs.columns if keep is None else keep), "_q")
    counted = materialize(counted, "counts", "zstd") if keep is None else checkpointed(counted)  # whole texts compress well
    rules = votes(F.col("_q"))
    rows = counted.select(*[rules[r].alias(r) for r in RULES]).groupBy(*RULES).count().collect()  # at most 3 ** len(RULES) rows
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in rows)
    share, rates = fit(patterns)
    z = F.lit(math.log(share) - math.log(1 - share))
    for r, t in zip(RULES, rates, strict=False):  # no rates without documents
        z += F.when(rules[r] == -1, _evidence(t, -1)).when(rules[r] == 1, _evidence(t, 1)).otherwise(_evidence(t, 0))
    q = F.col("_q")
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    prob = 1 / (1 + F.exp(-z))
    return counted.withColumn("_p", F.struct(prob.alias("quality"), failed.alias("base_failed"), (~failed & (prob >= keep_from)).alias("kept")))


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents of good quality, with the input's columns."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    return judge(inner, names[text_col]).filter("_p.kept").select(*[F.col(a).alias(c) for c, a in names.items()])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, probability of good quality and verdict for every document."""
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    q, p = F.col("_q"), F.col("_p")
    return out.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      p["base_failed"].alias("base_failed"), p["kept"].alias("kept"), p["quality"].alias("quality"))
