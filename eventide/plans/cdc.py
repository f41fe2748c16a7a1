"""Change data and upsert tables over ``events`` and ``orders``.

* customer changes: each event is a change of its user's record
  ``(id, name, age, birthday)`` = ``(user_id, event_type, props.k, ts as text)``;
  ``signup`` creates (op ``c``), ``error`` deletes (op ``d``), any other event
  updates (op ``u``, ``before`` = the user's previous record).
* order messages: one JSON order per event, parsed with the tolerant JSON
  source, with the derived precombine text ``ts`` (first 17 chars of the
  order id) and ``partition_day`` (first 10 chars of the order time).
* orders upsert table: ``orders`` written in three commits (by priority
  class, so later commits also bring older rows), key ``o_custkey``,
  ordering ``(o_orderdate, o_orderkey)``, day partition ``partition_day``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import parse_json
from ..functions.parse import substr0, to_timestamp3
from ..operators.changes import decode_changes, encode_changes, precombine
from ..operators.sequence import with_previous
from ..operators.upsert import merge_changes, read_changes_since, read_log, read_snapshot, upsert
from ..session import scratch_path
from ..sources.tables import read_table

ROW_SCHEMA = "id bigint, name string, age int, birthday string"
ROW_COLS = ["id", "name", "age", "birthday"]
SPLIT = "segments"

ORDER_SCHEMA = ("orderId string, userId string, orderTime string, ip string, "
                "orderMoney double, orderStatus int")
ORDER_KEYS, ORDER_ORDERING, ORDER_PART = ["o_custkey"], ["o_orderdate", "o_orderkey"], "partition_day"
COMMITS = {1: ["1-URGENT", "2-HIGH"], 2: ["3-MEDIUM"], 3: None}        # the last takes all other priorities, NULL too


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), "ts", "event_type",
                     F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                     F.get_json_object("props", "$.k").cast("int").alias("age"),
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("birthday"))


def envelopes(spark: SparkSession, sf_dir: str, split=SPLIT) -> DataFrame:
    """``seq, value``: one change envelope per event."""
    rec = customer_records(spark, sf_dir)
    p = with_previous(rec, "id", ["ts", "seq"], ["name", "age", "birthday"], split=split, ts="ts")
    cur = F.struct(*[F.col(c) for c in ROW_COLS])
    prev = F.when(F.col("prev").isNotNull(),
                  F.struct(F.col("id"), *[F.col(f"prev.{c}").alias(c) for c in ROW_COLS[1:]]))
    op = (F.when(F.col("event_type") == "signup", "c")
           .when(F.col("event_type") == "error", "d").otherwise("u"))
    before = F.when(op == "d", cur).when(op == "u", prev)
    after = F.when(op != "d", cur)
    return p.select("seq", F.to_json(F.struct(before.alias("before"), after.alias("after"),
                                              op.alias("op"))).alias("value"))


def changes_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_changes(envelopes(spark, sf_dir), "value", ROW_SCHEMA, keep=["seq"])


def changes_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_changes(changes_decoded(spark, sf_dir), ROW_COLS, keep=["seq", "kind"])


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per id, the newest record by ``(ts, seq)`` unless that change is a delete."""
    d = (changes_decoded(spark, sf_dir).where(F.col("kind").isin("+I", "+U", "-D"))
         .withColumn("ts", to_timestamp3("birthday"))
         .withColumn("partition_day", substr0("birthday", 10)))
    w = precombine(d, "id", "ts", seq="seq")
    return w.where(F.col("kind") != "-D").select(*ROW_COLS, "ts", "partition_day")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.to_json(F.struct(
        F.concat(F.date_format("ts", "yyyyMMddHHmmssSSS"), F.col("event_id").cast("string")).alias("orderId"),
        F.col("user_id").cast("string").alias("userId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("orderTime"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.col("value").alias("orderMoney"),
        F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("orderStatus"),
    )).alias("value"))


def order_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = parse_json(order_messages(spark, sf_dir), "value", ORDER_SCHEMA, on_error="drop")
    return o.select("msg.*").select(
        "orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus",
        substr0("orderId", 17).alias("ts"), substr0("orderTime", 10).alias("partition_day"))


def _order_batch(spark: SparkSession, sf_dir: str, commit: int) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    named = [p for c in COMMITS.values() if c for p in c]
    own = F.col("o_orderpriority").isin(COMMITS[commit] or named)
    return (o.where(own if COMMITS[commit] else ~F.coalesce(own, F.lit(False)))
             .withColumn(ORDER_PART, F.date_format("o_orderdate", "yyyy-MM-dd")))


def write_orders_table(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders-upsert")
    for c in sorted(COMMITS):
        upsert(spark, path, _order_batch(spark, sf_dir, c), c, ORDER_KEYS, ORDER_PART)
    return path


def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot(spark, write_orders_table(spark, sf_dir), ORDER_KEYS, ORDER_ORDERING)


def changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_changes_since(spark, write_orders_table(spark, sf_dir), 1)


def compacted_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two commits merged and written once, the third merged onto the result."""
    path, base = write_orders_table(spark, sf_dir), scratch_path(spark, "orders-merged")
    merge_changes(read_log(spark, path, upto=2), ORDER_KEYS, ORDER_ORDERING).write.parquet(base)
    return read_snapshot(spark, path, ORDER_KEYS, ORDER_ORDERING, base=spark.read.parquet(base), after=2)


def limit20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * FROM table LIMIT 20``, made deterministic by ordering on the key."""
    return upsert_snapshot(spark, sf_dir).orderBy(*ORDER_KEYS).limit(20)


def _order_table(spark: SparkSession, sf_dir: str, key: str) -> str:
    """Order messages written in two commits: created orders, then paid ones."""
    path = scratch_path(spark, "order-table")
    derived = order_derived(spark, sf_dir)
    for commit, status in ((1, 1), (2, 2)):
        upsert(spark, path, derived.where(F.col("orderStatus") == status), commit, key, "partition_day")
    return path


def order_table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages upserted by ``orderId`` (precombine ``ts`` text, day partition), read back.

    Every order id is distinct, so the snapshot holds every derived row.
    """
    return read_snapshot(spark, _order_table(spark, sf_dir, "orderId"), "orderId", "ts")


def order_user_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages upserted by ``userId``: the user's latest order, whichever commit brought it."""
    return read_snapshot(spark, _order_table(spark, sf_dir, "userId"), "userId", ["ts", "orderId"])


def _change_table(spark: SparkSession, sf_dir: str) -> str:
    """All decoded change rows as three commits (days 1-10, 11-20, 21-31 of the change time).

    The decoded rows are written once, so that the commits do not decode again.
    """
    path, decoded = scratch_path(spark, "cdc-table"), scratch_path(spark, "cdc-changes")
    (changes_decoded(spark, sf_dir)
     .withColumn("ts", to_timestamp3("birthday")).withColumn("partition_day", substr0("birthday", 10))
     .withColumn("_c", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) + 1).write.parquet(decoded))
    d = spark.read.parquet(decoded)
    for commit in (1, 2, 3):
        upsert(spark, path, d.where(F.col("_c") == commit).drop("_c"), commit, "id", "partition_day", op_col="kind", seq="seq")
    return path


def cdc_table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows logged in a table keyed by ``id`` and read back.

    ``+I``/``+U`` rows upsert, ``-D`` rows delete, ``-U`` rows (retractions) stay
    in the log only. Precombine field is the derived ``ts`` (``birthday`` as
    TIMESTAMP(3)), ties to the later event; partition ``partition_day``.
    """
    return read_snapshot(spark, _change_table(spark, sf_dir), "id", "ts").select(*ROW_COLS, "ts", "partition_day")


def cdc_changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log after the first commit: every change row, all four kinds (U4)."""
    return read_changes_since(spark, _change_table(spark, sf_dir), 1).drop("seq")
