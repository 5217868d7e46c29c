"""Schema discovery over dirty lines, and parameterised SQL."""

from __future__ import annotations

import pytest

from fuelsight.sources import discovery as D
from fuelsight.sources.readers import read_sql

LINES = ['{"vin":"a","value":1,"n":1,"o":{"y":2}}', '{"vin":"b","value":"1.5","n":2}', '{"vin":null,"value":2.25,"o":[1]}', '{"value":"n/a","it\'s":true}',
         "broken", "[1]", None, "", "7", '{"vin":"c","value":3,"n":null}']


def frame(spark, lines=LINES):
    return spark.createDataFrame([(x, 1) for x in lines], "value string, key int")


def test_types_are_counted_and_chosen(spark):
    counts = {(r.key, r.type): r.n for r in D.field_types(frame(spark)).collect()}
    assert counts[("value", "whole")] == 2 and counts[("value", "number")] == 1 and counts[("value", "numeric_string")] == 1 and counts[("value", "string")] == 1
    assert counts[("vin", "null")] == 1 and counts[("o", "nested")] == 2 and sum(counts.values()) == 15
    assert D.discover(frame(spark)) == {"it's": "boolean", "n": "bigint", "o": "string", "value": "double", "vin": "string"}
    assert D.discover(frame(spark), numeric_share=0.9)["value"] == "string"
    with pytest.raises(ValueError, match="different fields"):
        D.discover(frame(spark), max_fields=3)


def test_rows_are_typed_and_drift_is_told(spark):
    df = frame(spark)
    rows, bad = D.read_lines(df, D.discover(df))
    got = {(r.vin, r.value): r for r in rows.collect()}
    assert set(got) == {("a", 1.0), ("b", 1.5), (None, 2.25), (None, None), ("c", 3.0)}
    assert got[(None, None)].drift == ["value"] and got[(None, None)]["it's"] is True and got[("a", 1.0)].drift == []
    assert got[("a", 1.0)].o == '{"y":2}'
    assert sorted(map(str, (r.value for r in bad.collect()))) == sorted(map(str, ["broken", "[1]", None, "", "7"]))
    some, _ = D.read_lines(df, {"vin": "string"})
    assert sorted(map(tuple, (r.extra for r in some.collect()))) == [("it's", "value"), ("n", "o", "value"), ("n", "value"), ("n", "value"), ("o", "value")]


def test_empty_and_hopeless_tables(spark):
    for lines in ([], ["broken", None]):
        df = frame(spark, lines)
        assert D.discover(df) == {} and D.field_types(df).count() == 0
        rows, bad = D.read_lines(df, {})
        assert rows.count() == 0 and bad.count() == len(lines)


def test_choose():
    assert D.choose({"null": 3}) == "string" and D.choose({"whole": 2, "null": 1}) == "bigint" and D.choose({"whole": 1, "number": 1}) == "double"
    assert D.choose({"boolean": 2, "string": 1}) == "string" and D.choose({"numeric_string": 5}) == "string"


def test_an_argument_stays_text(spark):
    df = spark.createDataFrame([("O'Hara", 1), ("x' OR '1'='1", 2), ("plain", 3)], "vin string, n int")
    for vin in ("O'Hara", "x' OR '1'='1", "'; DROP VIEW people; --"):
        got = read_sql(spark, "SELECT n FROM IDENTIFIER(:source) WHERE vin = :vin", {"source": "people", "vin": vin}, {"people": df}).collect()
        assert [r.n for r in got] == df.where(df.vin == vin).select("n").rdd.flatMap(list).collect()
    assert spark.table("people").count() == 3
    with pytest.raises(Exception, match="(?i)identifier|parse"):
        read_sql(spark, "SELECT * FROM IDENTIFIER(:source)", {"source": "people; DROP VIEW people"}).collect()
