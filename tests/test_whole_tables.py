"""No click and no order is lost where tables have gaps."""

import pytest
from pyspark.sql import functions as F

from eventide.plans import cdc, hot, parsing

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def gappy(spark, tmp_path):
    """The small tables with page ids that are not 0..n-1 and orders of unknown and no priority."""
    for t in ("events", "pages", "orders"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "pages":
            df = df.withColumn("page_id", F.col("page_id") * 2)
        if t == "orders":
            odd = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).when(F.col("o_orderkey") % 3 == 1, "9-NEW").otherwise(F.col("o_orderpriority"))
            df = df.withColumn("o_orderpriority", odd.cast("string"))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


def test_clicks_of_unlisted_pages_stay(spark, gappy):
    ev = spark.read.parquet(f"{gappy}/events.parquet")
    clicks = ev.where("event_type = 'click'").count()
    assert parsing.access_lines(spark, gappy).count() == ev.count()
    got = parsing.parse_access_log(spark, gappy)
    assert got.count() == clicks and got.where(F.col("url").startswith("unlisted page ")).count() > 0
    assert hot.hot_urls_counts(spark, gappy).agg(F.sum("n")).first()[0] == 120 * clicks       # each click is in 120 windows


def test_orders_of_any_priority_are_written(spark, gappy):
    batches = [cdc._order_batch(spark, gappy, c) for c in sorted(cdc.COMMITS)]
    assert sum(b.count() for b in batches) == spark.read.parquet(f"{gappy}/orders.parquet").count()
    want = spark.read.parquet(f"{gappy}/orders.parquet").select("o_custkey").distinct().count()
    assert cdc.upsert_snapshot(spark, gappy).count() == want
