import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators.sequence import adjacent_change, followed_by_within

T0 = dt.datetime(2024, 1, 1)


def sec(x):
    return T0 + dt.timedelta(seconds=x)


def test_adjacent_change_all_pairs(spark):
    df = spark.createDataFrame([("u", i, ip) for i, ip in enumerate("ABAA")] + [(None, 9, "Z")],
                               "user string, seq bigint, ip string")
    out = adjacent_change(df, "user", "seq", "ip").orderBy("seq").collect()
    assert [(r.seq, r.ip, r.prev_ip) for r in out] == [(1, "B", "A"), (2, "A", "B")]


def _model_adjacent(rows):
    out = set()
    by = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2])):
        p = by.get(r[0])
        if p is not None and p[3] != r[3]:
            out.add((r[0], r[2], r[3], p[2], p[3]))
        by[r[0]] = r
    return out


def test_adjacent_change_split_equals_model(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, 3, None]), sec(rnd.randrange(0, 5 * 86400)), i, rnd.randrange(3))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "u bigint, ts timestamp_ntz, seq bigint, v bigint")
    want = _model_adjacent(rows)
    for split in (None, "1 day", "3 hours", "auto"):
        got = {(r.u, r.seq, r.v, r.prev_seq, r.prev_v)
               for r in adjacent_change(df, "u", ["ts", "seq"], "v", split=split, ts="ts").collect()}
        assert got == want, split


def _c2(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq bigint, status string")
    return followed_by_within(df, "k", "ts", "seq", F.col("status") == "1", F.col("status") == "2",
                              "10 seconds", **kw)


def test_c2_fixture_rows(spark):
    def st(rows, **kw):
        return sorted((r.start_seq, r.status, r.end_seq) for r in _c2(spark, rows, **kw).collect())
    assert st([("o", sec(0), 1, "1"), ("o", sec(9.999), 2, "2")]) == [(1, "paid", 2)]
    assert st([("o", sec(0), 1, "1"), ("o", sec(10), 2, "2")]) == [(1, "timeout", None)]
    assert st([("o", sec(0), 1, "1"), ("o", sec(1), 2, "1"), ("o", sec(2), 3, "2")]) == [(1, "paid", 3), (2, "paid", 3)]
    assert st([("o", sec(0), 1, "1"), ("o", sec(1), 2, "2"), ("o", sec(2), 3, "2")]) == [(1, "paid", 2)]
    assert st([("o", sec(0), 1, "1"), ("o", sec(1), 2, "9"), ("o", sec(2), 3, "2")]) == [(1, "paid", 3)]
    assert st([("o", sec(0), 1, "2"), ("o", sec(1), 2, "1")]) == [(2, "timeout", None)]
    assert st([("o", sec(0), 1, "2"), ("o", sec(1), 2, "1")], as_of=sec(5)) == [(2, "pending", None)]
    assert st([("o", sec(0), 2, "1"), ("o", sec(0), 1, "2")]) == [(2, "timeout", None)]
    assert st([("o", sec(0), 1, "1"), ("o", sec(0), 2, "2")]) == [(1, "paid", 2)]


def _model_c2(rows, within):
    out = set()
    for k in {r[0] for r in rows}:
        ev = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2]))
        for i, r in enumerate(ev):
            if r[3] != "1":
                continue
            nxt = next((e for e in ev[i + 1:] if e[3] == "2"), None)
            if nxt is not None and nxt[1] < r[1] + within:
                out.add((k, r[2], "paid", nxt[2]))
            else:
                out.add((k, r[2], "timeout", None))
    return out


def test_c2_random_split_equals_model(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice("abc"), sec(rnd.randrange(0, 3 * 86400, 7)), i, rnd.choice("1229"))
            for i in range(1200)]
    want = _model_c2(rows, dt.timedelta(seconds=10))
    for split in (None, "1 hour", "10 seconds", "auto"):
        got = {(r.k, r.start_seq, r.status, r.end_seq) for r in _c2(spark, rows, split=split).collect()}
        assert got == want, split


def test_auto_split_sizes_buckets(spark):
    from eventide.operators.sequence import _position, auto_split
    rows = [(1 if i % 3 else 2, sec(i * 60), i) for i in range(3000)]   # key 1 holds 2/3 of the rows
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, seq bigint")
    p = _position(df, "ts")
    assert auto_split(df, "k", p, target_rows=5000) is None             # no hot key, no split
    assert 2900 * 60 * 1_000_000 // 16 <= auto_split(df, "k", p, target_rows=500) <= 3000 * 60 * 1_000_000 // 4
    assert auto_split(df, "k", p, min_length=10**15, target_rows=500) == 10**15
    burst = spark.createDataFrame([(1, sec(0), -1), (1, sec(30 * 86400), -2)] + [(1, sec(9 * 86400 + i // 50), i) for i in range(3000)],
                                  "k bigint, ts timestamp_ntz, seq bigint")
    assert auto_split(burst, "k", _position(burst, "ts"), target_rows=500) <= 10_000_000


def _null_rows():
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), None if rnd.random() < 0.1 else sec(rnd.randrange(0, 5000, 7)), i, rnd.choice("1229"))
            for i in range(600)]
    return rows + [("hot", sec(60 + i % 60), 1000 + i, rnd.choice("12")) for i in range(400)]      # one busy minute


def test_splits_agree_with_null_times_keys_and_a_burst(spark, monkeypatch):
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "AUTO_SPLIT_ROWS", 50)
    monkeypatch.setattr(sequence.auto_split, "__defaults__", (1, 50))
    df = spark.createDataFrame(_null_rows(), "k string, ts timestamp_ntz, seq bigint, v string").cache()
    for order in (["ts", "seq"], ["seq"]):
        results = []
        for split in (None, "1 minute", "auto"):
            out = sequence.adjacent_change(df, "k", order, "v", split=split, ts="ts")
            results.append(sorted(map(repr, out.collect())))
        assert results[0] == results[1] == results[2] and results[0]
    results = []
    for split in (None, "1 minute", "auto"):
        out = sequence.followed_by_within(df, "k", "ts", "seq", F.col("v") == "1", F.col("v") == "2", "10 seconds", split=split)
        results.append(sorted(map(repr, out.collect())))
    assert results[0] == results[1] == results[2]
    starts = sum(k is not None and v == "1" for k, _, _, v in _null_rows())
    assert len(results[0]) == starts                 # no start is lost, whatever its time


def test_segments_equal_the_unsplit_form(spark, monkeypatch):
    """One key with every row inside one bound, ties of time, times that are missing and an order by text."""
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "SEGMENT_ROWS", 40)
    monkeypatch.setattr(sequence, "SAMPLES", 8)
    rnd = random.Random(8)
    burst = [("hot", None if i % 50 == 0 else sec(rnd.randrange(9)), i, rnd.choice("1229"), f"{rnd.random():.9f}") for i in range(900)]
    rows = burst + [(rnd.choice(["a", None, "b"]), sec(i), 1000 + i, rnd.choice("129"), f"x{i:05d}") for i in range(120)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq bigint, v string, name string").cache()
    cuts = {r.k: len(r["_cuts"]) for r in sequence.segments(df, "k", ["ts", "seq"]).collect()}
    assert cuts["hot"] > 10 and cuts["hot"] > 5 * sum(n for k, n in cuts.items() if k != "hot")
    for order in (["ts", "seq"], ["seq"], ["name"]):
        got = [sorted(map(repr, adjacent_change(df, "k", order, "v", split=s).collect())) for s in (None, "segments")]
        assert got[0] == got[1] and got[0]
    c2 = lambda s: followed_by_within(df, "k", "ts", "seq", F.col("v") == "1", F.col("v") == "2", "10 seconds", cols=["name"], split=s)
    got = [sorted(map(repr, c2(s).collect())) for s in (None, "segments")]
    assert got[0] == got[1] and len(got[0]) > 100
    # A long way to the next end: many segments without one lie between.
    far = [("f", sec(0), 0, "1")] + [("f", sec(1), i, "9" if i % 3 else "1") for i in range(1, 500)] + [("f", sec(2), 999, "2")]
    got = sorted((r.start_seq, r.status, r.end_seq) for r in _c2(spark, far, split="segments").collect())
    assert got == [(r[2], "paid", 999) for r in far if r[3] == "1"]


def test_segments_find_their_rows_in_two_steps(spark, monkeypatch):
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "SEGMENT_ROWS", 2)
    monkeypatch.setattr(sequence, "SAMPLES", 2)
    df = spark.range(900).selectExpr("1 AS k", "id AS seq")
    cuts = sequence.segments(df, "k", "seq")
    at = [c.seq for c in cuts.first()["_cuts"]]
    assert len(at) > 3 * sequence._FINE and at == sorted(at)
    for r in sequence._in_segments(df, ["k"], ["seq"], cuts).collect():
        assert r["_b"] == sum(c <= r.seq for c in at)


def test_segments_exchange_the_rows_once(spark, monkeypatch):
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "SEGMENT_ROWS", 50)
    monkeypatch.setattr(sequence, "SAMPLES", 8)
    df = spark.range(400).selectExpr("id % 2 AS k", "id AS seq", "id % 3 AS v")
    assert sequence.segments(spark.range(40).selectExpr("id AS k", "id AS seq"), "k", "seq") is None
    plan = adjacent_change(df, "k", "seq", "v", split="segments")._jdf.queryExecution().executedPlan().toString()
    # The rows cross one exchange; the three others carry one row per segment and task at most.
    rows_side, summaries = plan.split("+- Range", 1)
    assert rows_side.count("Exchange hashpartitioning") == 1 and "Aggregate" not in rows_side
    assert summaries.count("Exchange hashpartitioning") == 3 and summaries.count("partial_max_by") == 1
