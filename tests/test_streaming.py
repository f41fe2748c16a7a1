import pytest
from pyspark.sql import functions as F

from eventide.operators.upsert import read_snapshot
from eventide.plans import cdc, etl, hot, patterns, streams
from eventide.session import scratch_path
from eventide.streaming.patterns import adjacent_change_per_batch, followed_by_per_batch
from eventide.streaming.enrich import DimensionSnapshot, enrich_per_batch
from eventide.streaming.runner import run_stream, stage_by_count
from eventide.streaming.upsert import append_changes, stream_changes, upsert_per_batch

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("stream_fn,batch_fn", [
    (streams.stream_hot_items_top5, hot.hot_items_top5),
    (streams.stream_order_status, patterns.order_status),
    (streams.stream_adjacent_change_q, patterns.adjacent_change_q),
    (streams.stream_order_timeout, patterns.order_timeout),
    (streams.stream_etl_enriched, etl.etl_enriched),
    (streams.stream_etl_lines, etl.etl_enriched_json),
    (streams.stream_upsert_snapshot, cdc.upsert_snapshot),
    (streams.stream_changes_since, cdc.changes_since),
    (streams.stream_hot_urls_top5, hot.hot_urls_top5),
])
def test_stream_equals_batch(spark, stream_fn, batch_fn):
    assert rows(stream_fn(spark, SF)) == rows(batch_fn(spark, SF))


def test_dimension_refresh_per_batch(spark):
    root = scratch_path(spark, "t-refresh")
    dim_path = f"{root}/dim"

    def publish(rows_):
        spark.createDataFrame(rows_, "area string, countries string").write.mode("overwrite").parquet(dim_path)

    from eventide.operators.enrich import invert_groups
    snap = DimensionSnapshot(lambda s: invert_groups(s.read.parquet(dim_path), "area", "countries",
                                                     member="country"))
    write = enrich_per_batch(snap, f"{root}/out", "data", ["dt"], "countryCode", "country", "area")
    msg = spark.createDataFrame([("d", "NO", [("ferry", 9.5, "late")])],
                                "dt string, countryCode string, data array<struct<type:string,score:double,level:string>>")
    publish([("east", "NO,SE")])
    write(msg, 0)
    publish([("west", "NO")])                      # replaced between batches
    write(msg, 1)
    publish([])                                    # an empty snapshot is ignored
    write(msg, 2)
    out = {r.batch: r.area for r in spark.read.parquet(f"{root}/out").collect()}
    assert out == {0: "east", 1: "west", 2: "west"}


def test_dimension_versions(spark):
    """Restart, empty load, failing load and replay all look up in the version they should."""
    root = scratch_path(spark, "t-versions")
    frame = lambda rows_: spark.createDataFrame(rows_, "area string, country string")
    loads = {"now": lambda s: frame([])}
    snap = lambda: DimensionSnapshot(lambda s: loads["now"](s), f"{root}/dim")
    seen = lambda snap_, b: (lambda d: d and sorted(map(tuple, d.collect())))(snap_.at(spark, b))
    first = snap()
    assert seen(first, 0) is None                                          # nothing published yet
    one, two = [("east", "K1"), ("west", "K2")], [("north", "K1")]
    loads["now"] = lambda s: frame(one)
    assert seen(first, 1) == one
    loads["now"] = lambda s: frame([])
    assert seen(snap(), 2) == one                                          # a restart with an empty source
    loads["now"] = lambda s: s.read.parquet(f"{root}/no-such-folder")
    with pytest.warns(UserWarning, match="version 1 kept"):
        assert seen(snap(), 3) == one                                      # a failing read
    loads["now"] = lambda s: frame([("x", "K")]).select(F.raise_error(F.lit("broken")).cast("string").alias("area"), "country")
    with pytest.warns(UserWarning, match="version 1 kept"):
        assert seen(snap(), 4) == one                                      # one that fails while it runs
    loads["now"] = lambda s: frame(two)
    assert seen(snap(), 5) == two
    loads["now"] = lambda s: frame([("late", "K1")])
    assert seen(snap(), 5) == two                                          # a replay: the version of its first run
    assert seen(snap(), 4) == one                                          # and the one before it
    loads["now"] = lambda s: frame(two)
    assert seen(snap(), 6) == two
    from eventide.session import finished_ids
    assert finished_ids(spark, f"{root}/dim", "version") == [5]            # equal rows are not written again, old ones go
    loads["now"] = lambda s: s.read.parquet(f"{root}/no-such-folder")
    with pytest.raises(Exception, match="no-such-folder"):
        DimensionSnapshot(lambda s: loads["now"](s), f"{root}/other").at(spark, 0)


def test_upsert_stream_restart(spark):
    root = scratch_path(spark, "t-restart")
    batches = [cdc._order_batch(spark, SF, c) for c in sorted(cdc.COMMITS)]
    schema = batches[0].schema
    for b in batches[:2]:
        b.coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        q = run_stream(s, f"{root}/ckpt", foreach_batch=upsert_per_batch(
            f"{root}/table", cdc.ORDER_KEYS, cdc.ORDER_PART))
        q.awaitTermination()

    run()
    batches[2].coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()                                          # restarts from the checkpoint
    got = read_snapshot(spark, f"{root}/table", cdc.ORDER_KEYS, cdc.ORDER_ORDERING)
    assert rows(got) == rows(cdc.upsert_snapshot(spark, SF))
    commits = {r[0] for r in spark.read.parquet(f"{root}/table/log").select("evt_commit").distinct().collect()}
    assert commits == {1, 2, 3}


@pytest.mark.parametrize("partition", [None, "day"])
def test_broken_commit_reaches_a_stream_once(spark, tmp_path, partition):
    """Files that a failed micro-batch left behind are seen by no reader; its replay is seen once."""
    import glob
    import os
    import shutil
    import time

    root, flag = scratch_path(spark, "t-once"), tmp_path / "fail"
    schema = "k bigint, v bigint, day string, no int"

    @F.udf("bigint")
    def guarded(v):
        if v == 19 and os.path.exists(flag):
            time.sleep(3)                              # the other tasks have written their files by now
            raise RuntimeError("broken off")
        return v

    def feed(lo, hi, no):
        for i in range(lo, hi):
            spark.createDataFrame([(i % 7, i, f"d{i % 2}", no)], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def write():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 10).parquet(f"{root}/in").withColumn("v", guarded("v"))
        append_changes(s, f"{root}/table", f"{root}/ckpt", "k", F.col("no"), seq="v", partition=partition).awaitTermination()

    def read():
        q = run_stream(stream_changes(spark, f"{root}/table"), f"{root}/ckpt-read", sink=f"{root}/seen")
        q.awaitTermination()
        return sorted(r.v for r in spark.read.parquet(f"{root}/seen").collect())

    feed(0, 10, 1)
    write()
    feed(10, 20, 2)
    flag.write_text("")
    with pytest.raises(Exception, match="broken off"):
        write()
    one = glob.glob(f"{root}/table/log/**/part-*.parquet", recursive=True)[0]
    shutil.copy(one, one.replace("part-", "part-9"))   # a killed driver could not even remove its files
    from eventide.operators.upsert import read_changes_since, read_log
    assert read() == list(range(10)) and read_log(spark, f"{root}/table").count() == 10
    flag.unlink()
    write()
    assert read() == list(range(20))
    assert sorted(r.v for r in read_changes_since(spark, f"{root}/table", 1).collect()) == list(range(10, 20))
    snap = read_snapshot(spark, f"{root}/table", "k", "v")
    assert sorted((r.k, r.v) for r in snap.collect()) == [(i % 7, i) for i in sorted(range(13, 20), key=lambda i: i % 7)]


def test_stream_read_needs_the_sink_log(spark):
    root = scratch_path(spark, "t-folders")
    upsert_per_batch(root, "k", "k")(spark.range(3).withColumnRenamed("id", "k"), 0)
    with pytest.raises(ValueError, match="append_changes"):
        stream_changes(spark, root)


def test_rocksdb_state_store(spark):
    from eventide.streaming.runner import use_rocksdb_state
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    try:
        use_rocksdb_state(spark)
        got = streams.stream_adjacent_change_q(spark, SF)
        assert rows(got) == rows(patterns.adjacent_change_q(spark, SF))
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _at(seconds):
    import datetime as dt
    return None if seconds is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


ORDER = "k string, ts timestamp_ntz, seq bigint, status string"


def _order_pattern(root, **kw):
    return followed_by_per_batch(root, "k", "ts", "seq", F.col("status") == "1", F.col("status") == "2", "10 seconds", **kw)


def test_out_of_order_within_delay(spark):
    batches = [[("o", _at(10), 1, "1"), ("x", _at(30), 2, "1")],
               [("o", _at(12), 3, "2")],                                # the end at 12 s arrives later
               [("z", _at(1000), 4, "9")]]                              # moves event time on

    def run(delay):
        root = scratch_path(spark, "t-late")
        find = _order_pattern(root, delay=delay)
        for i, b in enumerate(batches):
            find(spark.createDataFrame(b, ORDER), i)
        return {r.start_seq: r.status for r in spark.read.parquet(f"{root}/out").where("k = 'o'").collect()}

    # 25 s allowed: event time is 5 s after the first batch, the start is still open.
    # Nothing allowed: event time is 30 s, the start has timed out and the end is late.
    assert run("25 seconds") == {1: "paid"}
    assert run("0 seconds") == {1: "timeout"}


def test_paid_rows_leave_before_their_bound(spark):
    """A paid row leaves once event time has passed its end, a timeout at its deadline; nothing leaves twice."""
    root = scratch_path(spark, "t-prompt")
    find = _order_pattern(root)
    batches = [[("a", _at(0), 1, "1"), ("a", _at(1), 2, "1"), ("b", _at(0), 3, "1"), ("a", _at(3), 4, "2")],
               [("c", _at(4), 5, "9")],                                  # passes the end at 3 s
               [("a", _at(5), 6, "1"), ("a", _at(6), 7, "2"), ("c", _at(9), 8, "9")],
               [("c", _at(10), 9, "9")],                                 # b's deadline
               [("c", _at(99), 10, "9")]]
    for i, b in enumerate(batches):
        find(spark.createDataFrame(b, ORDER), i)
    got = {(r.batch, r.start_seq, r.end_seq, r.status) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(1, 1, 4, "paid"), (1, 2, 4, "paid"), (2, 6, 7, "paid"), (3, 3, None, "timeout")}


def test_event_that_starts_and_ends(spark):
    """An event may be a start and an end: emitted as a start, it still ends earlier starts, and itself never."""
    from eventide.operators.sequence import followed_by_within
    import random
    rnd = random.Random(4)
    events = sorted(((rnd.choice("ab"), _at(rnd.randrange(200)), i, rnd.choice("123")) for i in range(250)), key=lambda e: (e[1], e[2]))
    is_start, is_end = F.col("status").isin("1", "3"), F.col("status").isin("2", "3")
    root = scratch_path(spark, "t-both")
    find = followed_by_per_batch(root, "k", "ts", "seq", is_start, is_end, "10 seconds", cols=["status"])
    for n in range(5):
        find(spark.createDataFrame(events[50 * n:50 * n + 50], ORDER), n)
    find(spark.createDataFrame([("end", _at(9999), -1, "9")], ORDER), 5)
    want = followed_by_within(spark.createDataFrame(events, ORDER), "k", "ts", "seq", is_start, is_end, "10 seconds", cols=["status"])
    assert rows(spark.read.parquet(f"{root}/out").drop("batch")) == rows(want)


def test_pattern_batches_equal_the_batch_form(spark):
    import random
    from eventide.operators.sequence import followed_by_within
    rnd = random.Random(9)
    events = sorted(((rnd.choice(["a", "a", "b", None]), rnd.choice([None, *range(0, 300, 3)]), i, rnd.choice("1129"))
                     for i in range(300)), key=lambda e: (e[1] or 0, e[2]))
    events = [(k, _at(t), i, s) for k, t, i, s in events]
    root = scratch_path(spark, "t-pattern")
    find = _order_pattern(root)
    cuts = [0, 40, 41, 150, 150, 299, 300]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        find(spark.createDataFrame(events[a:b], ORDER), n)
        if n in (1, 3):
            find(spark.createDataFrame(events[a:b], ORDER), n)           # a replayed batch changes nothing
    find(spark.createDataFrame([("end", _at(9999), -1, "9")], ORDER), len(cuts))
    want = followed_by_within(spark.createDataFrame(events, ORDER), "k", "ts", "seq", F.col("status") == "1",
                              F.col("status") == "2", "10 seconds")
    got = spark.read.parquet(f"{root}/out").drop("batch")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("split", ["auto", "3 seconds"])
def test_adjacent_change_per_batch(spark, split):
    import random
    rng, root = random.Random(3), scratch_path(spark, "t-adjacent")
    write, state, want = adjacent_change_per_batch(root, "k", ["ts", "seq"], "v", cols=["big"], split=split), {}, []
    for b in range(4):
        part = [] if b == 2 else [
            (rng.choice(["hot", "hot", "hot", "a", "b", None]), _at(rng.choice([None, 20 * b + rng.randrange(-15, 15)])),
             100 * b + i, rng.choice([None, 1, 2]), 2**53 + 100 * b + i) for i in range(40)]
        batch = spark.createDataFrame(part, "k string, ts timestamp_ntz, seq bigint, v bigint, big bigint").repartition(3)
        write(batch, b)
        write(batch, b)                            # a replay gives the same
        for r in sorted((r for r in part if r[0]), key=lambda r: (r[1] is not None, str(r[1]), r[2])):
            if r[0] in state and state[r[0]][3] != r[3]:
                want.append((*r, *state[r[0]][1:]))
            state[r[0]] = r
    got = spark.read.parquet(f"{root}/out").select("k", "ts", "seq", "v", "big", "prev_ts", "prev_seq", "prev_v", "prev_big").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) > 20


def test_last_events_write_their_own_buckets_only(spark):
    """Ten keys over many known ones: the micro-batch writes and reads their buckets, and merging changes nothing."""
    import random

    from eventide.streaming.patterns import LastEvents
    root, rng = scratch_path(spark, "t-state"), random.Random(6)
    write = adjacent_change_per_batch(root, "k", ["seq"], "v", buckets=32, merge_every=3)
    many = spark.range(100_000).selectExpr("id AS k", "id AS seq", "id % 5 AS v")
    write(many, 0)
    model, want = {i: (i, i % 5) for i in range(100_000)}, []
    for b in range(1, 9):
        part = [(rng.randrange(20), 1_000_000 * b + i, rng.randrange(5)) for i in range(10)]
        frame = spark.createDataFrame(part, "k bigint, seq bigint, v bigint")
        for _ in range(2 if b in (3, 6, 7) else 1):                     # replays, also of a batch that merges
            write(frame, b)
        for k, q, v in part:
            if model[k][1] != v:
                want.append((k, q, v, *model[k]))
            model[k] = (q, v)
        if b == 1:
            log = spark.read.parquet(f"{root}/last/batch=1")
            assert log.count() == len({p[0] for p in part}) and len(log.inputFiles()) <= 10
            known = LastEvents(root, "k", 32).before(frame, 2, [3])
            plan = known._jdf.queryExecution().executedPlan().toString()
            assert 0 < known.count() < 6_000 and "_bucket" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    got = spark.read.parquet(f"{root}/out").select("k", "seq", "v", "prev_seq", "prev_v").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert LastEvents(root, "k", 32).before(frame, 99).count() == 100_000
    from eventide.session import finished_ids
    assert len(finished_ids(spark, f"{root}/state", "batch")) <= 2 and len(finished_ids(spark, f"{root}/last", "batch")) <= 7
    again = adjacent_change_per_batch(root, "k", ["seq"], "v", buckets=32, merge_every=3)      # a restart
    again(spark.createDataFrame([(99_999, 10**9, 77)], "k bigint, seq bigint, v bigint"), 9)
    last = spark.read.parquet(f"{root}/out/batch=9").collect()
    assert [(r.k, r.v, r.prev_seq) for r in last] == [(99_999, 77, 99_999)]


def test_window_state_of_a_slice_is_bounded(spark, monkeypatch):
    """More rows are more slices: no micro-batch holds more window state for a larger table, results stay."""
    monkeypatch.setattr(streams, "WINDOW_ROWS", 300)
    root = scratch_path(spark, "t-slices")
    started = {}
    monkeypatch.setattr(streams, "_replay", lambda s, start: started.update(q=start()) or started["q"].awaitTermination())
    monkeypatch.setattr(streams, "scratch_path", lambda s, name: root)
    with streams.state_partitions(spark):
        assert rows(streams.stream_hot_urls_top5(spark, SF)) == rows(hot.hot_urls_top5(spark, SF))
    state = [op["numRowsTotal"] for p in started["q"].recentProgress for op in p["stateOperators"]]
    clicks = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'click'").count()
    assert 0 < max(state) < clicks * 120 / 7


def test_slices_of_equal_rows(spark):
    """Cut by count: a time held by many rows stays whole, rows without a time come first, every row once."""
    path = scratch_path(spark, "t-equal")
    df = spark.range(1000).selectExpr(
        "id", "CASE WHEN id % 10 = 9 THEN NULL WHEN id < 900 THEN timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id div 100) "
        "ELSE timestamp_ntz'2999-01-01' END AS ts")
    assert stage_by_count(df, "ts", path, 8, 2) == 2
    files = spark.read.parquet(path).selectExpr("id", "ts", "_metadata.file_path AS f", "_metadata.file_modification_time AS m")
    assert sorted(r["id"] for r in files.collect()) == list(range(1000))
    assert files.where("ts IS NOT NULL").groupBy("ts").agg(F.countDistinct("f").alias("k")).agg(F.max("k")).first()[0] <= 2
    per = [r["n"] for r in files.groupBy("f").agg(F.count("*").alias("n")).collect()]
    assert len(per) % 2 == 0 and len(per) >= 12 and max(per) <= 200
    lo, hi = files.where("ts IS NULL").agg(F.max("m")).first()[0], files.where("ts = timestamp_ntz'2999-01-01'").agg(F.min("m")).first()[0]
    assert lo <= hi
