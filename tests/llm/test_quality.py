"""Quality rules: base counts against plain Python, EM against planted accuracies, labelled documents."""

import random
import re

from fuelsight.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, window=8):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    hit = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + window)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def counts(df):
    return {r.doc_id: tuple(r["_q"][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            for r in Q.judge(df).collect()}


def test_base_counts(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "x " * 8, "x " * 9, "a b c d e f g h " * 3, "é ñ b\x1cz  #$|\n\n#$|\r\nü😀", "l\nl\nl \n", "w" * 9000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n&&"]) for _ in range(80)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert counts(d) == {i: brute(t) for i, t in enumerate(texts)}


def test_base_counts_of_a_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert counts(d) == {r.doc_id: brute(r.text) for r in d.collect()}


def test_em_recovers_rates():
    rng = random.Random(7)
    right, share = [0.95, 0.9, 0.8, 0.85, 0.7], 0.75
    found = {}
    for _ in range(40000):
        good = rng.random() < share
        p = tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < a) == good else -1) for a in right)
        found[p] = found.get(p, 0) + 1
    got_share, rates = Q.fit(sorted(found.items()), 300)
    assert abs(got_share - share) < 0.03
    for a, t in zip(right, rates):
        assert abs(t[1][0] - 0.8 * a) < 0.03 and abs(t[-1][1] - 0.8 * a) < 0.05


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op2_quality_rules(spark, sf).select("doc_id", "n_words", "base_failed", "kept")
    got = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    junk = [r.kept for r in got if r.quality == 0]
    assert len(good) > 100 and sum(good) >= 0.99 * len(good)
    assert len(junk) > 10 and sum(junk) <= 0.1 * len(junk)


def test_posterior_decides_not_a_single_rule(spark):
    plain = "The quick brown fox jumps over the lazy dog near river bank while children play games and sing songs loudly today outside. "
    texts = [plain + f"number {i} word{i} other{i}" for i in range(60)]
    one_bad = texts[0] + " !!!!!!!!!!!!!!!!!!!!"
    junk = " ".join(f"#{i}$%&|!!" for i in range(60))
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, one_bad, junk, "short text"])], "doc_id long, text string")
    kept = {r.doc_id: r["_p"].kept for r in Q.judge(d).collect()}
    assert all(kept[i] for i in range(61)) and not kept[61] and not kept[62]


def test_keep_columns_and_empty(spark):
    d = spark.createDataFrame([(1, "a b", "x", "y"), (None, None, None, None)], "doc_id long, text string, _q string, `a.b` string")
    assert Q.keep(d).columns == d.columns and Q.keep(d).count() == 0
    assert Q.judge(d.limit(0).select("doc_id", "text")).count() == 0


def test_main_path_has_no_python(spark):
    plan = Q.op2_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
