"""Keyed event patterns over ``events``.

* adjacent change (login job shape): per user, consecutive events (by
  ``ts``, ``event_id``) whose ``props.k`` differs -- the "same user, new IP"
  rule with ``k`` standing in for the IP.
* order status (order-timeout job shape): per user, a ``click`` starts an
  order and the first later ``purchase`` within one hour pays it; otherwise
  the order times out. Paid rows report the purchase, timeouts the click.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_datetime, parse_delimited
from ..operators.sequence import adjacent_change, followed_by_within
from ..session import scratch_path
from ..sources.lines import read_lines, write_lines
from ..sources.tables import read_table

WITHIN = "1 hour"
SPLIT = "segments"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def adjacent_change_q(spark: SparkSession, sf_dir: str, split=SPLIT) -> DataFrame:
    ev = _events(spark, sf_dir).select(
        "user_id", "event_id", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return adjacent_change(ev, "user_id", ["ts", "event_id"], "k", split=split, ts="ts")


def order_status(spark: SparkSession, sf_dir: str, split=SPLIT, within: str = WITHIN) -> DataFrame:
    ev = _events(spark, sf_dir)
    return followed_by_within(ev, "user_id", "ts", "event_id",
                              F.col("event_type") == "click", F.col("event_type") == "purchase",
                              within, cols=["value"], split=split)


def order_status_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status at the order job's own bound of ten seconds."""
    return order_status(spark, sf_dir, within="10 seconds")


def order_status_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status as known a day before the last event: unpaid orders still in time are ``pending``."""
    ev = _events(spark, sf_dir)
    as_of = ev.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("t")).first()["t"]
    return followed_by_within(ev, "user_id", "ts", "event_id",
                              F.col("event_type") == "click", F.col("event_type") == "purchase",
                              WITHIN, cols=["value"], as_of=as_of, split=SPLIT)


def order_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main output: the paying event of each matched order."""
    s = order_status(spark, sf_dir)
    return s.where(F.col("status") == "paid").select(
        "user_id", F.col("end_event_id").alias("event_id"), F.col("end_ts").alias("ts"),
        F.col("end_value").alias("value"))


def order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side output: the start event of each order that timed out."""
    s = order_status(spark, sf_dir)
    return s.where(F.col("status") == "timeout").select(
        "user_id", F.col("start_event_id").alias("event_id"), F.col("start_ts").alias("ts"),
        F.col("start_value").alias("value"))


def login_changes_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``arrival,user,k`` lines: consecutive lines of a user, by arrival, whose ``k`` differs."""
    path = scratch_path(spark, "login-lines")
    k = F.get_json_object("props", "$.k")
    write_lines(_events(spark, sf_dir).select(F.concat_ws(",", "event_id", "user_id", k).alias("value")), path)
    lines = parse_delimited(read_lines(spark, path), "value", "event_id bigint, user_id bigint, k bigint")
    return adjacent_change(lines, "user_id", ["event_id"], "k", split=SPLIT)


def order_status_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id,status,user,date`` lines: status 1 starts an order, 2 pays it."""
    path = scratch_path(spark, "order-lines")
    kind = F.col("event_type")
    status = F.when(kind == "click", "1").when(kind == "purchase", "2").otherwise("9")
    date = F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    write_lines(_events(spark, sf_dir).select(F.concat_ws(",", "event_id", status, "user_id", date).alias("value")), path)
    lines = parse_delimited(read_lines(spark, path), "value", "event_id bigint, status string, user_id bigint, date string")
    return followed_by_within(lines.withColumn("ts", parse_datetime("date")), "user_id", "ts", "event_id",
                              F.col("status") == "1", F.col("status") == "2", WITHIN, split=SPLIT)
