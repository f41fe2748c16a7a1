"""Delimited-line jobs: user behaviour lines and access-log lines.

Lines are rendered from ``events`` in the reference's wire forms, then parsed
back with :func:`parse_delimited` (strict longs, no quoting, extra fields
ignored, bad lines fail the job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import (epoch_millis_to_ts, epoch_seconds_to_ts, parse_delimited,
                               ts_to_epoch_millis, ts_to_epoch_seconds)
from ..session import scratch_path
from ..sources.lines import read_lines, write_lines
from ..sources.tables import read_table
from .hot import with_url

BEHAVIOR_SCHEMA = "user_id bigint, item_id bigint, category_id bigint, behavior string, ts_seconds bigint"
ACCESS_SCHEMA = "ip string, user_name string, event_ms bigint, method string, url string"


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``userId,itemId,categoryId,behavior,epochSeconds`` per event."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(F.concat_ws(",", "user_id", k, k % 10, "event_type",
                                 ts_to_epoch_seconds("ts")).alias("value"))


def parse_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_delimited(behavior_lines(spark, sf_dir), "value", BEHAVIOR_SCHEMA)
    return p.withColumn("event_time", epoch_seconds_to_ts("ts_seconds"))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ip,userId,epochMillis,method,url`` per event: a click is a GET of its page, the rest are POSTs."""
    ev = read_table(spark, sf_dir, "events")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    clicks = ev.select((F.col("event_id") % n_pages).alias("page_id"), "user_id", "ts",
                       F.when(F.col("event_type") == "click", "GET").otherwise("POST").alias("method"))
    j = with_url(clicks, pages)
    return j.select(F.concat_ws(",",
                                F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"),
                                         F.lit("."), F.col("page_id") % 256),
                                "user_id", ts_to_epoch_millis("ts"), "method", "url").alias("value"))


def parse_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines parsed, then the job's filter on GET."""
    p = parse_delimited(access_lines(spark, sf_dir), "value", ACCESS_SCHEMA).where(F.col("method") == "GET")
    return p.withColumn("event_time", epoch_millis_to_ts("event_ms"))


def behavior_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour lines written as a text topic stand-in, read back and parsed."""
    path = scratch_path(spark, "behavior-lines")
    write_lines(behavior_lines(spark, sf_dir), path)
    p = parse_delimited(read_lines(spark, path), "value", BEHAVIOR_SCHEMA)
    return p.withColumn("event_time", epoch_seconds_to_ts("ts_seconds"))
