"""Streaming forms of the jobs, replayed over the supplied tables.

Each query stages its input from the tables into a fresh folder under the
shared checkpoint folder -- time-ordered slices, one micro-batch each -- runs
the streaming operator to completion with an ``availableNow`` trigger, and
returns what the stream wrote. A bounded replay has no end-of-stream signal,
so one end-of-input event far in the future is appended last; it moves the
watermark past every real window and bound and never appears in a result.
The results equal the batch queries of the same name without ``stream_``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.intervals import interval_us
from ..functions.json import parse_json
from ..functions.parse import parse_delimited, substr0
from ..operators.changes import decode_changes
from ..operators.upsert import read_snapshot
from ..session import scratch_path
from ..sources.dimension import read_dimension
from ..sources.json_table import read_json_table
from ..sources.lines import read_lines, with_arrival, write_lines
from ..sources.positions import POSITION_BITS, read_positioned_lines
from ..sources.tables import read_table
from ..streaming.enrich import DimensionSnapshot, enrich_per_batch
from ..streaming.patterns import adjacent_change_per_batch, followed_by_per_batch
from ..streaming.runner import (append_markers, run_stream, split_outputs_per_batch, stage_by_count,
                                stage_by_time, state_partitions)
from ..streaming.topn import event_time, top_n_per_batch, window_counts_stream
from ..streaming.upsert import append_changes, stream_changes, upsert_per_batch
from . import cdc, etl, hot, patterns

SLICES = 6
WINDOW_ROWS = 500_000                               # keys and windows that one slice adds to a state partition, at most about
END_OF_INPUT = dt.datetime(2999, 1, 1)


def _files_per_slice(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _staged_events(spark: SparkSession, sf_dir: str, root: str, types: tuple[str, ...] = (), jitter: int = 0,
                   fan_out: int = 0):
    """Events replayed as a stream, up to ``jitter`` seconds out of order, then end-of-input markers.

    ``fan_out``: windows that an event of ``types`` is in. A larger table is then replayed in
    more slices, so that the window state of a slice does not grow with the table.

    Filters on ``event_type`` are pushed below the watermark (and into the
    Parquet scan), so each filtered branch only sees its own types: the
    markers carry every type in ``types`` (negative event ids, NULL props).
    """
    ev = read_table(spark, sf_dir, "events")
    path = f"{root}/in"
    late = F.expr(f"timestampadd(SECOND, event_id % {jitter + 1}, ts)")        # when the event arrives
    staged, per_trigger = ev.withColumn("_arrives", late), _files_per_slice(spark)
    slices = _window_slices(spark, ev.where(F.col("event_type").isin(*types)).count(), fan_out) if fan_out else SLICES
    if slices > SLICES:
        stage_by_count(staged, "_arrives", path, slices, per_trigger)
    else:
        stage_by_time(staged, "_arrives", path, SLICES, per_trigger)
    kinds = list(types) or ["end-of-input"]

    def markers(k: int) -> DataFrame:
        n = per_trigger * len(kinds)
        return spark.range(n).select(
            (F.lit(-1 - k * n) - F.col("id")).alias("event_id"),
            F.lit(END_OF_INPUT + dt.timedelta(seconds=k)).cast("timestamp_ntz").alias("ts"),
            F.lit(-1).cast("bigint").alias("user_id"),
            F.element_at(F.array(*[F.lit(t) for t in kinds]),
                         (F.col("id") % len(kinds) + 1).cast("int")).alias("event_type"),
            F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
    append_markers(markers, path, per_trigger)
    return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", per_trigger)
            .parquet(path))


def _window_slices(spark: SparkSession, rows: int, fan_out: int) -> int:
    """Slices that leave each state partition ``WINDOW_ROWS`` of ``rows * fan_out`` or less; not under ``SLICES``."""
    stores = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    return max(SLICES, -(-rows * fan_out // (WINDOW_ROWS * stores)))


def _replay(spark: SparkSession, start) -> None:
    with state_partitions(spark):
        _drain(start)


def _drain(start) -> None:
    """Start a replay (``start()`` returns the query) and wait for it to finish."""
    q = start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-hot-items")
    e = event_time(_staged_events(spark, sf_dir, root, ("view",), fan_out=interval_us(hot.ITEM_SIZE) // interval_us(hot.ITEM_SLIDE)), "ts")
    views = (e.where(F.col("event_type") == "view")
              .select(F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "_et"))
    counts = window_counts_stream(views, "item_id", "_et", hot.ITEM_SIZE, hot.ITEM_SLIDE)
    _replay(spark, lambda: run_stream(counts, f"{root}/ckpt",
                      foreach_batch=top_n_per_batch(f"{root}/out", hot.TOP, ties=["item_id"])))
    return spark.read.parquet(f"{root}/out").drop("batch")


def stream_hot_urls_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on a stream: clicks joined to the static pages table, 10 min / 5 s windows."""
    root = scratch_path(spark, "stream-hot-urls")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.count()
    e = event_time(_staged_events(spark, sf_dir, root, ("click",), fan_out=interval_us(hot.URL_SIZE) // interval_us(hot.URL_SLIDE)), "ts")
    clicks = (e.where(F.col("event_type") == "click")
               .select((F.col("event_id") % F.lit(n_pages)).alias("page_id"), "_et"))
    counts = window_counts_stream(hot.with_url(clicks, pages), "url", "_et", hot.URL_SIZE, hot.URL_SLIDE)
    _replay(spark, lambda: run_stream(counts, f"{root}/ckpt",
                                      foreach_batch=top_n_per_batch(f"{root}/out", hot.TOP, ties=["url"])))
    return spark.read.parquet(f"{root}/out").drop("batch")


def _replay_orders(spark: SparkSession, sf_dir: str, root: str, emit=None) -> None:
    """C2 over events up to 4 s out of order, with 5 s allowed."""
    ev = _staged_events(spark, sf_dir, root, jitter=4)
    find = followed_by_per_batch(root, "user_id", "ts", "event_id", F.col("event_type") == "click",
                                 F.col("event_type") == "purchase", patterns.WITHIN, cols=["value"],
                                 delay="5 seconds", emit=emit)
    _drain(lambda: run_stream(ev, f"{root}/ckpt", foreach_batch=find))


def stream_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-orders")
    _replay_orders(spark, sf_dir, root)
    return spark.read.parquet(f"{root}/out").drop("batch")


def stream_order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main and side output from one stream: paid events and timed-out starts, two sinks."""
    root = scratch_path(spark, "stream-order-outputs")
    outputs = {
        f"{root}/paid": (F.col("status") == "paid",
                         ["user_id", F.col("end_event_id").alias("event_id"),
                          F.col("end_ts").alias("ts"), F.col("end_value").alias("value")]),
        f"{root}/timeout": (F.col("status") == "timeout",
                            ["user_id", F.col("start_event_id").alias("event_id"),
                             F.col("start_ts").alias("ts"), F.col("start_value").alias("value")]),
    }
    _replay_orders(spark, sf_dir, root, split_outputs_per_batch(outputs))
    return spark.read.parquet(f"{root}/timeout").drop("batch")


def stream_adjacent_change_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-adjacent")
    ev = _staged_events(spark, sf_dir, root).where(F.col("event_id") >= 0).select(
        "user_id", "event_id", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    find = adjacent_change_per_batch(root, "user_id", ["ts", "event_id"], "k")
    _drain(lambda: run_stream(ev, f"{root}/ckpt", foreach_batch=find))
    return spark.read.parquet(f"{root}/out").drop("batch")


def stream_login_changes_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The login job end to end: text lines as a stream, consecutive ones of a user by their place in the files."""
    root = scratch_path(spark, "stream-login-lines")
    k = F.get_json_object("props", "$.k")
    ev = read_table(spark, sf_dir, "events").repartitionByRange("event_id").sortWithinPartitions("event_id")
    write_lines(ev.select(F.concat_ws(",", "event_id", "user_id", k).alias("value")), f"{root}/in")
    lines = read_positioned_lines(spark, f"{root}/in", stream=True, log=f"{root}/files")
    rows = parse_delimited(lines, "value", "event_id bigint, user_id bigint, k bigint", keep=["seq"])
    find = adjacent_change_per_batch(root, "user_id", ["seq"], "k", cols=["event_id"])
    _drain(lambda: run_stream(rows, f"{root}/ckpt", foreach_batch=find))
    return spark.read.parquet(f"{root}/out").drop("batch", "seq", "prev_seq")


def stream_order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-table job end to end: JSON lines as a stream, derived fields, the table's log, its snapshot."""
    root = scratch_path(spark, "stream-order-table")
    write_lines(cdc.order_messages(spark, sf_dir), f"{root}/in")
    orders = read_json_table(spark, cdc.ORDER_SCHEMA, f"{root}/in", stream=True, positions=True, log=f"{root}/files")
    rows = orders.withColumn("ts", substr0("orderId", 17)).withColumn("partition_day", substr0("orderTime", 10))
    file_number = F.shiftright("seq", POSITION_BITS) + 1
    _drain(lambda: append_changes(rows, f"{root}/table", f"{root}/ckpt", "orderId", file_number, seq="seq"))
    return read_snapshot(spark, f"{root}/table", "orderId", "ts").drop("seq")


def stream_etl_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a stream; the area dimension re-read at every micro-batch."""
    root = scratch_path(spark, "stream-etl")
    etl.messages(spark, sf_dir).repartition(_files_per_slice(spark)).write.parquet(f"{root}/in")
    etl.dimension_inverted(spark, sf_dir).write.parquet(f"{root}/dim")
    per = max(1, _files_per_slice(spark) // 4)
    msgs = (spark.readStream.schema("value string").option("maxFilesPerTrigger", per)
            .parquet(f"{root}/in"))
    parsed = parse_json(msgs, "value", etl.MESSAGE_SCHEMA, required=["data"]).select("msg.*")
    dim = DimensionSnapshot(lambda s: s.read.parquet(f"{root}/dim"), f"{root}/dim-versions")
    _replay(spark, lambda: run_stream(parsed, f"{root}/ckpt",
                      foreach_batch=enrich_per_batch(dim, f"{root}/out", "data", ["dt"], "countryCode",
                                                     "country", "area")))
    return spark.read.parquet(f"{root}/out").drop("batch")


def stream_etl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL job end to end: message lines in, published areas looked up, JSON lines out."""
    root = scratch_path(spark, "stream-etl-lines")
    write_lines(etl.messages(spark, sf_dir), f"{root}/in")
    etl.area_hash(spark, sf_dir).write.parquet(f"{root}/dim")
    lines = read_lines(spark, f"{root}/in", stream=True)
    parsed = parse_json(lines, "value", etl.MESSAGE_SCHEMA, required=["data"]).select("msg.*")
    dim = DimensionSnapshot(lambda s: read_dimension(s, f"{root}/dim"), f"{root}/dim-versions")
    _drain(lambda: run_stream(parsed, f"{root}/ckpt", foreach_batch=enrich_per_batch(
        dim, f"{root}/out", "data", ["dt"], "countryCode", "country", "area", lines=True)))
    return spark.read.text(f"{root}/out").select("value")


def stream_change_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes as text lines, decoded in arrival order, logged by ``id`` and read back."""
    root = scratch_path(spark, "stream-change-capture")
    write_lines(cdc.envelopes(spark, sf_dir).repartitionByRange("seq").sortWithinPartitions("seq"), f"{root}/in")
    lines = read_lines(spark, f"{root}/in", stream=True)

    def decoded(batch: DataFrame, batch_id: int) -> DataFrame:
        rows = decode_changes(with_arrival(batch, batch_id), "value", cdc.ROW_SCHEMA, keep=["seq"])
        return rows.withColumn("partition_day", substr0("birthday", 10))
    _drain(lambda: run_stream(lines, f"{root}/ckpt", foreach_batch=upsert_per_batch(
        f"{root}/table", "id", "partition_day", op_col="kind", seq="seq", prepare=decoded)))
    return read_snapshot(spark, f"{root}/table", "id", "birthday").select(*cdc.ROW_COLS, "partition_day")


def _stream_orders_table(spark: SparkSession, sf_dir: str) -> str:
    """The order changes, numbered by their commit, streamed into a table's log."""
    root = scratch_path(spark, "stream-upsert")
    per = _files_per_slice(spark)
    for c in sorted(cdc.COMMITS):
        rows = cdc._order_batch(spark, sf_dir, c).withColumn("commit_no", F.lit(c))
        rows.repartition(per).write.mode("append").parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", per).parquet(f"{root}/in")
    _drain(lambda: append_changes(changes, f"{root}/table", f"{root}/ckpt", cdc.ORDER_KEYS, F.col("commit_no")))
    return f"{root}/table"


def stream_upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stream_orders_table(spark, sf_dir)
    return read_snapshot(spark, path, cdc.ORDER_KEYS, cdc.ORDER_ORDERING).drop("commit_no")


def stream_changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits after the first, read back through the streaming change-log source."""
    path = _stream_orders_table(spark, sf_dir)
    root = scratch_path(spark, "stream-changelog")
    log = stream_changes(spark, path).where(F.col("_commit") > 1).drop("commit_no", "_seq")
    _replay(spark, lambda: run_stream(log, f"{root}/ckpt", sink=f"{root}/out"))
    return spark.read.parquet(f"{root}/out")
