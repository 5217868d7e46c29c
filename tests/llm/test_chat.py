"""Layouts to turns, reversible escapes, loss spans, and the query against DuckDB."""

import json
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fuelsight.llm import chat as C

RECORDS = [
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"id": 5, "prompt": "p", "completion": None}, [("user", "p"), ("assistant", "")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "a\"b"}, {"content": "<|end|>", "role": "assistant"}]},
     [("system", "s"), ("user", "a\"b"), ("assistant", "<|end|>")]),
    ({"conversations": [{"from": "human", "value": "é"}, {"from": "gpt", "value": None}], "source": {"a": 1}}, [("user", "é"), ("assistant", "")]),
    ({"what": "ever"}, None),
    ({"messages": []}, None),
]


def test_json_layouts(spark):
    d = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(90, None), (91, "no json"), (92, "[1]")], "k int, record string")
    got = {r.k: None if r.turns is None else [tuple(t) for t in r.turns] for r in C.json_turns(d, "record").collect()}
    assert got == {**{i: t for i, (_, t) in enumerate(RECORDS)}, 90: None, 91: None, 92: None}


def test_typed_layouts(spark):
    d = spark.createDataFrame([("i", None, "o", 1)], "instruction string, input string, output string, other int")
    assert [tuple(t) for t in C.table_turns(d).first().turns] == [("user", "i"), ("assistant", "o")]
    d = spark.createDataFrame([([("human", "h"), (None, None)],)], "conversations array<struct<`from`: string, value: string>>")
    assert [tuple(t) for t in C.table_turns(d).first().turns] == [("user", "h"), ("", "")]
    with pytest.raises(ValueError):
        C.table_turns(spark.range(1))


def check(spark, conversations):
    rows = [(i, [{"role": a, "text": b} for a, b in c]) for i, c in enumerate(conversations)]
    d = spark.createDataFrame(rows, "k int, turns array<struct<role: string, text: string>>")
    f = d.select("k", "turns", C.format_turns(F.col("turns")).alias("f"))
    for r in f.select("*", C.parse(F.col("f.text")).alias("back"), C.learned(F.col("f.text"), F.col("f.loss")).alias("learned")).collect():
        assert r.back == r.turns
        spans = [r.f.text[s.start:s.start + s.length] for s in r.f.loss]
        mine = [t.text for t in r.turns if t.role == "assistant"]
        assert len(spans) == len(mine) and r.learned == "".join(mine)
        for t in spans:
            assert "<" not in t and "[" not in t
        assert r.f.text.count(C.TURN) == len(r.turns)


texts = st.lists(st.sampled_from([*"\\<[|lb/s>aé😀\n$", "<|turn|>", "<|end|>", "</s>", "[INST]"]), max_size=12).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a<|text|>b\n"]), texts), max_size=4), min_size=20, max_size=60))
def test_round_trip(spark, conversations):
    check(spark, conversations)


def test_long_text(spark):
    check(spark, [[("user", "\\<" * 50000), ("assistant", "[" * 70000)]])


def test_null_ties_and_empty(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, None, None), (None, 0, "gpt", "x"), (1, 1, "user", "a")]
    d = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, rows string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in C.table_turns(d).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("assistant", "x")]}
    assert C.table_turns(d.limit(0)).count() == 0


def test_query_equals_duckdb_and_is_native(spark):
    sf = "/root/testdata/sf0.01"
    df = C.op8_chat_formatting(spark, sf)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    got = con.execute(C.ORACLE)
    assert [x[0] for x in got.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(got.fetchall())
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
