import pytest
import datetime as dt

from pyspark.sql import functions as F

from eventide.operators.changes import decode_changes, encode_changes, precombine
from eventide.operators.upsert import merge_changes, read_changes_since, read_log, read_snapshot, upsert
from eventide.session import scratch_path

ROW = "id int, name string"


def test_decode_ops(spark):
    texts = [
        '{"before":null,"after":{"id":1,"name":"a"},"op":"c"}',
        '{"after":{"id":2,"name":"b"},"op":"r"}',
        '{"before":{"id":1,"name":"a"},"after":{"id":1,"name":"a2"},"op":"u"}',
        '{"before":{"id":2,"name":"b"},"op":"d"}',
        "{broken", None, '{"after":{"id":3,"name":"x"},"op":"z"}', '{"op":"c"}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, value string")
    out = sorted((r.seq, r.kind, r.id, r.name) for r in decode_changes(df, "value", ROW, keep=["seq"]).collect())
    assert out == [(0, "+I", 1, "a"), (1, "+I", 2, "b"), (2, "+U", 1, "a2"), (2, "-U", 1, "a"), (3, "-D", 2, "b")]


def test_encode_round_trip(spark):
    df = spark.createDataFrame([("+I", 1, "a"), ("-U", 1, "a"), ("+U", 1, "b"), ("-D", 1, "b")],
                               "kind string, id int, name string")
    enc = encode_changes(df, ["id", "name"], keep=["kind"]).collect()
    assert {(r.kind, r.value) for r in enc} == {
        ("+I", '{"after":{"id":1,"name":"a"},"op":"c"}'), ("-U", '{"before":{"id":1,"name":"a"},"op":"d"}'),
        ("+U", '{"after":{"id":1,"name":"b"},"op":"c"}'), ("-D", '{"before":{"id":1,"name":"b"},"op":"d"}')}


def test_precombine_tie_goes_to_later_seq(spark):
    df = spark.createDataFrame([(1, 5, 1, "x"), (1, 5, 2, "y"), (2, 1, 3, "z")], "k int, o int, s int, v string")
    assert sorted((r.k, r.v) for r in precombine(df, "k", "o", seq="s").collect()) == [(1, "y"), (2, "z")]


COLS = "id int, v string, ts bigint, day string, op string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _snap(spark, path):
    return sorted((r.id, r.v, r.day) for r in read_snapshot(spark, path, "id", "ts").collect())


def test_upsert_rules(spark):
    path = scratch_path(spark, "t-upsert")
    up = lambda rows, c: upsert(spark, path, _batch(spark, rows), c, "id", "day", op_col="op")
    up([(1, "a", 10, "d1", "U"), (2, "b", 10, "d1", "U"), (3, "c", 10, "d2", "U")], 1)
    assert _snap(spark, path) == [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")]
    up([(1, "old", 5, "d1", "U"), (2, "moved", 11, "d3", "U"), (3, "gone", 12, "d2", "D")], 2)
    assert _snap(spark, path) == [(1, "a", "d1"), (2, "moved", "d3")]
    # replaying commit 2 leaves the table as it is
    up([(1, "old", 5, "d1", "U"), (2, "moved", 11, "d3", "U"), (3, "gone", 12, "d2", "D")], 2)
    assert _snap(spark, path) == [(1, "a", "d1"), (2, "moved", "d3")]
    ch = read_changes_since(spark, path, 1).collect()
    assert sorted((r.id, r._op, r._commit) for r in ch) == [(1, "U", 2), (2, "U", 2), (3, "D", 2)]
    up([(1, "new", 20, "d2", "U")], 3)
    assert _snap(spark, path) == [(1, "new", "d2"), (2, "moved", "d3")]
    snap = read_snapshot(spark, path, "id", "ts")
    assert snap.where(F.col("day") == "d1").count() == 0      # the last key left d1


def _merged(spark, path, upto):
    out = scratch_path(spark, "t-merged")
    merge_changes(read_log(spark, path, upto=upto), "id", "ts").write.parquet(out)
    return spark.read.parquet(out)


def test_snapshot_onto_merged_rows(spark):
    path = scratch_path(spark, "t-paths")
    up = lambda rows, c: upsert(spark, path, _batch(spark, rows), c, "id", "day", op_col="op")
    up([(1, "a", 10, "d1", "U"), (2, "b", 10, "d1", "U"), (3, "c", 10, "d2", "U"), (4, "e", 10, "d2", "U"),
        (6, "z", 9, "d1", "U"), (6, "z", 10, "d1", "D")], 1)
    base = _merged(spark, path, 1)
    up([(1, "stale", 5, "d1", "U"), (2, "newer", 11, "d3", "U"), (3, "x", 12, "d2", "D"),
        (5, "fresh", 1, "d4", "U"), (4, "tie", 10, "d2", "U"), (6, "older than its delete", 9, "d1", "U")], 2)
    want = [(1, "a", "d1"), (2, "newer", "d3"), (4, "tie", "d2"), (5, "fresh", "d4")]
    got = read_snapshot(spark, path, "id", "ts", base=base, after=1)
    assert sorted((r.id, r.v, r.day) for r in got.collect()) == want == _snap(spark, path)
    assert read_changes_since(spark, path, 2).count() == 0


def test_log_keeps_every_change_of_a_commit(spark):
    path = scratch_path(spark, "t-log")
    rows = [(1, "a", 1, "d1", "+I"), (1, "a", 1, "d1", "-U"), (1, "b", 2, "d1", "+U"), (2, "c", 1, "d1", "+I"), (2, "c", 3, "d1", "-D")]
    upsert(spark, path, _batch(spark, rows), 1, "id", "day", op_col="op")
    assert sorted((r.id, r.v, r._op) for r in read_changes_since(spark, path, 0).collect()) == sorted((i, v, o) for i, v, _, _, o in rows)
    assert _snap(spark, path) == [(1, "b", "d1")]


def test_insert_values_table(spark):
    # Two INSERT ... VALUES into a keyed table.
    path = scratch_path(spark, "t-values")
    schema = "uuid string, name string, age int, ts string, partition string"
    rows = [("k-7", "Mira", 41, "1700000001", "north"), ("k-8", "Oskar", 19, "1700000002", "north")]
    for n, row in enumerate(rows, 1):
        upsert(spark, path, spark.createDataFrame([row], schema), n, "uuid", "partition")
    assert sorted(tuple(r) for r in read_snapshot(spark, path, "uuid", "ts").collect()) == rows


def test_unfinished_commit_is_not_read_and_replaced_by_its_replay(spark):
    import glob
    import os
    path = scratch_path(spark, "t-crash")
    up = lambda rows, c: upsert(spark, path, _batch(spark, rows), c, "id", "day", op_col="op")
    up([(1, "a", 1, "d1", "U")], 1)
    up([(2, "b", 1, "d1", "U")], 2)
    folder = f"{path}/log/evt_commit=2".removeprefix("file:")
    for f in glob.glob(f"{folder}/*_SUCCESS") + glob.glob(f"{folder}/.*_SUCCESS*"):
        os.remove(f)                               # a crash imitated: part files without the success file
    assert _snap(spark, path) == [(1, "a", "d1")]
    assert read_changes_since(spark, path, 0).count() == 1
    up([(2, "b", 1, "d1", "U"), (3, "c", 1, "d1", "U")], 2)
    assert _snap(spark, path) == [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d1")]
    before = sorted(glob.glob(f"{folder}/part-*"))
    up([(2, "b", 1, "d1", "U"), (3, "c", 1, "d1", "U")], 2)          # a finished commit is not written again
    assert sorted(glob.glob(f"{folder}/part-*")) == before
    with pytest.raises(Exception, match="NULL key"):
        up([(None, "x", 1, "d1", "U")], 3)


def test_upsert_random_model(spark):
    import random
    rnd = random.Random(5)
    path = scratch_path(spark, "t-random")
    base, after = None, 0
    state = {}                                     # key -> (ts, commit, seq, v, day, op)
    for commit in range(1, 7):
        rows = []
        for seq in range(40):
            k = rnd.randrange(12)
            rows.append((k, f"v{commit}_{seq}", rnd.randrange(6), f"d{rnd.randrange(3)}",
                         "D" if rnd.random() < 0.2 else "U", seq))
        df = spark.createDataFrame(rows, "id int, v string, ts bigint, day string, op string, s bigint")
        upsert(spark, path, df, commit, "id", "day", op_col="op", seq="s")
        for k, v, ts, day, op, seq in rows:
            rank = (ts, commit, seq)
            if k not in state or rank > state[k][0]:
                state[k] = (rank, v, day, op)
        if rnd.random() < 0.4:
            base, after = _merged(spark, path, commit), commit
        want = sorted((k, v, day) for k, (_, v, day, op) in state.items() if op != "D")
        for snap in (read_snapshot(spark, path, "id", "ts"), read_snapshot(spark, path, "id", "ts", base=base, after=after)):
            assert sorted((r.id, r.v, r.day) for r in snap.collect()) == want, commit
