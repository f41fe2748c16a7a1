import json

from pyspark.sql import functions as F

from eventide.functions.json import parse_json, to_json_text
from eventide.operators.enrich import explode_enrich, invert_groups

SCHEMA = "dt string, countryCode string, data array<struct<type: string, score: double, level: string, dt: string>>"


def test_invert_groups_max_wins(spark):
    dim = spark.createDataFrame([("inland", "PE,BO"), ("lakes", "BO")], "area string, countries string")
    out = {r.country: r.area for r in invert_groups(dim, "area", "countries", member="country").collect()}
    assert out == {"PE": "inland", "BO": "lakes"}


def _msgs(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return parse_json(df, "value", SCHEMA, required=["data"]).select("msg.*")


def test_explode_enrich_edges(spark):
    msgs = _msgs(spark,
                 '{"dt":"2031-11-20 17:42:09","countryCode":"NO","data":[{"type":"ferry","score":12.25,"level":"late","dt":"old"},{"type":"tram","score":3.5,"level":"on time"},{"type":"cable","level":"closed"}]}',
                 '{"dt":"2031-11-20 18:00:30","countryCode":"QX","data":[{"type":"night bus","score":40.0,"level":"late"}]}',
                 '{"dt":"2031-11-20 18:01:00","countryCode":"NO","data":[]}')
    dim = spark.createDataFrame([("NO", "fjords")], "country string, area string")
    out = explode_enrich(msgs, "data", carry=["dt"], dim=dim, key="countryCode",
                         dim_key="country", dim_value="area")
    rows = sorted((r.type, r.dt, r.area) for r in out.collect())
    assert rows == [("cable", "2031-11-20 17:42:09", "fjords"), ("ferry", "2031-11-20 17:42:09", "fjords"),
                    ("night bus", "2031-11-20 18:00:30", None), ("tram", "2031-11-20 17:42:09", "fjords")]
    js = [json.loads(r[0]) for r in out.select(to_json_text(*[F.col(c) for c in out.columns])).collect()]
    unknown = [j for j in js if j["type"] == "night bus"][0]
    assert "area" not in unknown and unknown["dt"] == "2031-11-20 18:00:30"


def test_dimension_join_is_left_to_spark(spark):
    msgs = _msgs(spark, '{"dt":"d","countryCode":"NO","data":[{"type":"ferry","score":9.0,"level":"late"}]}')
    dim = spark.createDataFrame([("NO", "fjords")], "country string, area string")
    out = explode_enrich(msgs, "data", carry=["dt"], dim=dim, key="countryCode",
                         dim_key="country", dim_value="area")
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString() and out.count() == 1


def test_open_keys_forwarded(spark):
    from eventide.operators.enrich import explode_enrich_open
    df = spark.createDataFrame([
        ('{"dt":"D1","countryCode":"NO","data":[{"type":"ferry"},{"type":"tram","dt":"old","x":{"y":[1,2]}},{"type":"lift"}]}',),
        ('{"dt":"D2","countryCode":"QX","data":[{"type":"night bus","area":"stale"}]}',),
        ('{"dt":"D3","countryCode":"NO","data":[]}',), ("not json",), ('{"dt":"D4"}',), ('{"dt":"D6","data":"oops"}',),
        ('{"dt":"D5","countryCode":"NO","data":[7,"x",null]}',)], "value string")
    dim = spark.createDataFrame([("NO", "fjords")], "country string, area string")
    out = explode_enrich_open(df, "value", "$.data", {"dt": "$.dt"}, dim=dim, key_path="$.countryCode",
                              dim_key="country", dim_value="area")
    got = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in out.collect())
    want = sorted(json.dumps(x, sort_keys=True) for x in [
        {"type": "ferry", "dt": "D1", "area": "fjords"},
        {"type": "tram", "x": {"y": [1, 2]}, "dt": "D1", "area": "fjords"},
        {"type": "lift", "dt": "D1", "area": "fjords"},
        {"type": "night bus", "dt": "D2"}])
    assert got == want


def test_fail_also_when_columns_are_pruned(spark):
    import pytest

    from eventide.functions.parse import parse_delimited
    lines = spark.createDataFrame([("1,a",), ("x,b",)], "value string")
    with pytest.raises(Exception, match="malformed line"):
        parse_delimited(lines, "value", "n bigint, s string").count()
    msgs = spark.createDataFrame([('{"dt":"d"}',), ("oops",)], "value string")
    with pytest.raises(Exception, match="malformed JSON"):
        parse_json(msgs, "value", "dt string").count()
