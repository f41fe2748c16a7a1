"""The order job as SQL statements: views, a table partitioned by day, INSERT ... SELECT, a read by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalog import create_table, insert_select
from ..session import scratch_path
from ..sources.tables import register_views
from .cdc import ORDER_SCHEMA

ORDER_COLUMNS = ["orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus", "ts", "partition_day"]

MESSAGES = """
    SELECT to_json(named_struct(
        'orderId', concat(date_format(ts, 'yyyyMMddHHmmssSSS'), event_id), 'userId', string(user_id),
        'orderTime', date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS'), 'ip', concat('10.0.0.', user_id % 256),
        'orderMoney', value, 'orderStatus', if(event_type = 'purchase', 2, 1))) AS value
    FROM events"""

DERIVED = f"""
    SELECT o.*, substring(o.orderId, 1, 17) AS ts, substring(o.orderTime, 1, 10) AS partition_day
    FROM (SELECT from_json(value, '{ORDER_SCHEMA}') AS o FROM order_messages) WHERE o.orderId IS NOT NULL"""


def order_day_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of a new table, partitioned by day, that holds all derived orders."""
    name = f"orders_by_day_{uuid.uuid4().hex[:12]}"
    register_views(spark, sf_dir, ["events"])
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW order_messages AS {MESSAGES}")
    create_table(spark, name, f"{ORDER_SCHEMA}, ts string, partition_day string", scratch_path(spark, "orders-by-day"), "partition_day")
    insert_select(spark, name, ORDER_COLUMNS, DERIVED, "partition_day")
    return name


def order_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(order_day_table(spark, sf_dir))


def order_day_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and money per status on the table's last day; no other day's files are read."""
    name = order_day_table(spark, sf_dir)
    day = spark.sql(f"SELECT max(partition_day) AS d FROM {name}").first()["d"]
    return spark.sql(f"""
        SELECT partition_day, orderStatus, count(*) AS orders, round(sum(orderMoney), 2) AS money FROM {name}
        WHERE partition_day = ? GROUP BY partition_day, orderStatus""", args=[day])
