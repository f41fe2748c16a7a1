import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.functions.json import parse_json
from eventide.functions.parse import (epoch_millis_to_ts, epoch_seconds_to_ts, parse_datetime,
                                      parse_delimited, substr0, to_timestamp3, ts_to_epoch_seconds)

SCHEMA = "user_id bigint, item_id bigint, category_id bigint, behavior string, ts bigint"


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_extra_fields_ignored(spark):
    r = parse_delimited(lines(spark, "1,2,3,pv,4,extra"), "value", SCHEMA).collect()
    assert [tuple(x) for x in r] == [(1, 2, 3, "pv", 4)]


@pytest.mark.parametrize("bad", ["1, 2,3,pv,4", "1,2,3", '1,2,3,"p,v",4', "", "a,2,3,pv,4"])
def test_bad_lines(spark, bad):
    df = lines(spark, bad, "5,6,7,pv,8")
    q = parse_delimited(df, "value", SCHEMA, on_error="quarantine").collect()
    flagged = {r["_bad_line"] for r in q if r["_bad_line"] is not None}
    assert flagged == {bad}
    kept = parse_delimited(df, "value", SCHEMA, on_error="drop").collect()
    assert [r["user_id"] for r in kept] == [5]
    with pytest.raises(Exception):
        parse_delimited(df, "value", SCHEMA, on_error="fail").collect()


def test_trailing_empty_fields_dropped_like_java(spark):
    s = "a string, b string, c string"
    r = parse_delimited(lines(spark, "x,,y,,"), "value", s, on_error="quarantine").first()
    assert (r["a"], r["b"], r["c"], r["_bad_line"]) == ("x", "", "y", None)
    r = parse_delimited(lines(spark, "x,y,,"), "value", s, on_error="quarantine").first()
    assert r["_bad_line"] == "x,y,,"


def test_substring_from_zero(spark):
    df = spark.createDataFrame([("20240102030405678900042", "2024-01-02 03:04:05.678")], "o string, t string")
    r = df.select(substr0("o", 17).alias("a"), substr0("t", 10).alias("b")).first()
    assert (r.a, r.b) == ("20240102030405678", "2024-01-02")


def test_timestamp3_cast(spark):
    df = spark.createDataFrame([("bad",), ("2024-01-02 03:04:05.6789",), (None,)], "s string")
    r = [x[0] for x in df.select(to_timestamp3("s")).collect()]
    assert r == [None, dt.datetime(2024, 1, 2, 3, 4, 5, 678000), None]


def test_pattern_parse_and_epoch0(spark):
    df = spark.createDataFrame([("2022-01-01 10:00:00",), ("nope",)], "s string")
    r = [x[0] for x in df.select(parse_datetime("s")).collect()]
    assert r == [dt.datetime(2022, 1, 1, 10), None]
    r = [x[0] for x in df.select(parse_datetime("s", epoch0=True)).collect()]
    assert r[1] == dt.datetime(1970, 1, 1)


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(1511658000, 1431857105000)], "s bigint, ms bigint")
    r = df.select(epoch_seconds_to_ts("s").alias("a"), epoch_millis_to_ts("ms").alias("b")).first()
    assert r.a == dt.datetime(2017, 11, 26, 1, 0)
    assert r.b == dt.datetime(2015, 5, 17, 10, 5, 5)
    back = df.select(epoch_seconds_to_ts("s").alias("t")).select(ts_to_epoch_seconds("t")).first()[0]
    assert back == 1511658000


def test_json_parse_tolerant(spark):
    df = lines(spark, '{"a": 1, "b": "x"}', '{"a": 2}', "not json", "[]", "")
    schema = "a bigint, b string"
    q = parse_json(df, "value", schema, on_error="quarantine").collect()
    good = [(r.msg.a, r.msg.b) for r in q if r._bad_json is None]
    assert good == [(1, "x"), (2, None)]
    assert len(parse_json(df, "value", schema, on_error="drop").collect()) == 2
    with pytest.raises(Exception):
        parse_json(df, "value", schema, on_error="fail").collect()
    req = parse_json(df, "value", schema, on_error="drop", required=["b"]).collect()
    assert [r.msg.a for r in req] == [1]


def test_fail_splits_a_line_once(spark):
    """The failing check reads the projected row and flag; it does not split the line for every field."""
    df = spark.createDataFrame([("1,2,x",)], "value string")
    plan = parse_delimited(df, "value", "a bigint, b bigint, c string")._jdf.queryExecution().executedPlan().toString()
    generate = next(x for x in plan.splitlines() if "Generate" in x)
    assert "split(" not in generate and "raise_error" in generate
