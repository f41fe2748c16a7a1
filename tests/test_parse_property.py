"""parse_delimited against a plain-Python model of Java split + Long.parseLong."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide.functions.parse import parse_delimited

SCHEMA = "a bigint, b string, c bigint"


def java_split(s: str, sep: str = ","):
    parts = s.split(sep)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_long(t: str):
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    v = int(t)
    return v if -2**63 <= v < 2**63 else None


def model(line: str):
    f = java_split(line)
    if len(f) < 3:
        return None
    a, c = java_long(f[0]), java_long(f[2])
    if a is None or c is None:
        return None
    return (a, f[1], c)


lines = st.lists(st.text(alphabet="0129,+- a", max_size=14), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines)
def test_matches_java_model(spark, batch):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(batch)], "i int, value string")
    out = parse_delimited(df, "value", SCHEMA, on_error="quarantine", keep=["i"]).collect()
    got = {r.i: (None if r._bad_line is not None else (r.a, r.b, r.c)) for r in out}
    assert got == {i: model(v) for i, v in enumerate(batch)}
