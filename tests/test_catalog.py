"""Catalog tables: statements, partition pruning, partitions of other writers."""

import re

import pytest
from pyspark.sql import functions as F

from eventide.operators.catalog import create_table, insert_select, insert_values, refresh_table
from eventide.plans import catalog, cdc
from eventide.session import scratch_path

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_job_as_statements(spark):
    got = catalog.order_table_sql(spark, SF).select(*catalog.ORDER_COLUMNS)
    want = cdc.order_derived(spark, SF).select(*catalog.ORDER_COLUMNS)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() > 0


def test_one_day_reads_one_partition(spark):
    name = catalog.order_day_table(spark, SF)
    days = [r.d for r in spark.sql(f"SELECT DISTINCT partition_day AS d FROM {name} ORDER BY d").collect()]
    assert len(days) > 5
    one = spark.table(name).where(F.col("partition_day") == days[3])
    assert "PartitionFilters: [isnotnull(partition_day" in plan(one)
    assert {re.search(r"partition_day=([^/]+)", f)[1] for f in one.inputFiles()} >= {days[3]}
    one.collect()
    read = one._jdf.queryExecution().executedPlan()
    scan = read.collectLeaves().head()
    assert scan.metrics().apply("numPartitions").value() == 1
    assert 1 <= scan.metrics().apply("numFiles").value() <= 2           # rebalanced: not a file per task
    got = catalog.order_day_sql(spark, SF).collect()
    assert {r.partition_day for r in got} == {days[-1]}
    assert sum(r.orders for r in got) == spark.table(name).where(F.col("partition_day") == days[-1]).count()


@pytest.fixture
def table(spark):
    name, at = "t_catalog_rows", scratch_path(spark, "t-catalog")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, "k bigint, v string, day string", at, "day")
    yield name, at
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_insert_values_and_overwrite(spark, table):
    name, _ = table
    rows = [(1, "it's", "2024-01-01"), (2, None, "2024-01-02"), (None, "", None)]
    insert_values(spark, name, ["k", "v", "day"], rows)
    insert_values(spark, name, ["k", "v", "day"], [])
    assert sorted(map(tuple, spark.table(name).collect()), key=repr) == sorted(rows, key=repr)
    insert_select(spark, name, ["v", "day", "k"], f"SELECT 'x' AS v, day, k FROM {name} WHERE k = 1", "day")
    assert spark.table(name).count() == 4
    insert_select(spark, name, ["k", "v", "day"], "SELECT 9L AS k, 'y' AS v, '2024-01-09' AS day", "day", overwrite=True)
    assert list(map(tuple, spark.table(name).collect())) == [(9, "y", "2024-01-09")]


def test_partitions_of_other_writers(spark, table):
    name, at = table
    insert_values(spark, name, ["k", "v", "day"], [(1, "a", "2024-01-01")])
    spark.createDataFrame([(2, "b")], "k bigint, v string").write.parquet(f"{at}/day=2024-01-02")
    assert sorted(r.k for r in refresh_table(spark, name).collect()) == [1, 2]
    again = "t_catalog_again"
    spark.sql(f"DROP TABLE IF EXISTS {again}")
    create_table(spark, again, "k bigint, v string, day string", at, "day")          # over files that are there already
    assert sorted((r.k, r.day) for r in spark.table(again).collect()) == [(1, "2024-01-01"), (2, "2024-01-02")]
    spark.sql(f"DROP TABLE {again}")
