import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators.topn import render_ranking, top_n
from eventide.operators.windows import sliding_counts

T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "k bigint, ts timestamp_ntz")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_boundary_event_in_windows_starting_there(spark):
    df = events(spark, [(1, T0 + dt.timedelta(minutes=5))])
    out = sliding_counts(df, "k", "ts", "1 hour", "5 minutes", with_start=True).collect()
    starts = sorted(r.window_start for r in out)
    assert len(out) == 12
    assert starts[-1] == T0 + dt.timedelta(minutes=5)        # the one starting there
    assert all(r.window_end != T0 + dt.timedelta(minutes=5) for r in out)  # not the one ending there


def test_panes_equal_window_function(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(5), T0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400), microseconds=rnd.randrange(10**6)))
            for _ in range(3000)]
    df = events(spark, rows)
    for size, slide in [("1 hour", "5 minutes"), ("10 minutes", "5 seconds"), ("10 seconds", "4 seconds"),
                        ("2 days", "6 hours")]:
        a = rows_of(sliding_counts(df, "k", "ts", size, slide, method="panes", split="1 hour"))
        b = rows_of(sliding_counts(df, "k", "ts", size, slide, method="window"))
        assert a == b, (size, slide)


def test_weighted_counts(spark):
    df = spark.createDataFrame([(1, T0, 3), (1, T0 + dt.timedelta(seconds=1), 4)],
                               "k bigint, ts timestamp_ntz, w bigint")
    out = sliding_counts(df, "k", "ts", "10 seconds", "5 seconds", weight="w").collect()
    assert sorted(r.n for r in out) == [7, 7]


def test_top_n_fewer_rows_and_ties(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "x", 1)],
                               "g int, key string, n bigint")
    out = top_n(df, "g", "n", 5, ties=["key"]).orderBy("g", "rank").collect()
    assert [(r.g, r.key, r.rank) for r in out] == [(1, "c", 0), (1, "a", 1), (1, "b", 2), (2, "x", 0)]
    assert top_n(df, "g", "n", 1, ties=["key"]).count() == 2


def test_top_n_plans_group_limit(spark):
    df = spark.createDataFrame([(1, "a", 1)], "g int, key string, n bigint")
    plan = top_n(df, "g", "n", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_report_layout(spark):
    end = dt.datetime(2017, 11, 26, 9, 5)
    df = spark.createDataFrame([(end, 30577, 918, 0), (end, 7, 10, 1)],
                               "window_end timestamp_ntz, item_id bigint, n bigint, rank int")
    r = render_ranking(df, "window_end", "item_id", "n").first()
    assert r.report == ("====================================\n"
                        "时间: 2017-11-26 09:05:00.0\n"
                        "No0:  商品ID=30577  浏览量=918\n"
                        "No1:  商品ID=7  浏览量=10\n"
                        "====================================\n\n")


def test_pane_plan_shape(spark):
    # Pane counts cross one shuffle (partial aggregation before it), the
    # (key, bucket) repartition is the second; the window fan-out and the final
    # sum run without another exchange, and no 120-way Expand is planned.
    rows = [(1, T0 + dt.timedelta(seconds=i)) for i in range(10)]
    df = sliding_counts(events(spark, rows), "k", "ts", "10 minutes", "5 seconds")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Expand" not in plan
    assert "partial_count" in plan


def test_fan_out_keeps_the_partition_number(spark):
    """The exchange before the fan-out has the session's partition number, which adaptive execution keeps."""
    df = spark.range(200).select(F.col("id").alias("k"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"))
    counts = sliding_counts(df, "k", "ts", "10 minutes", "5 seconds")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert f", {n}), REPARTITION_BY_NUM" in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.rdd.getNumPartitions() == int(n)
