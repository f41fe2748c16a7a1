"""Streaming sliding top-N (T2): append-mode window counts, top-N per micro-batch.

A window's counts are emitted once, in append mode, when the watermark
passes the window end -- for every key of that window in the same
micro-batch, since one watermark closes them all. The top-N cut can therefore
run as a plain batch :func:`~eventide.operators.topn.top_n` inside
``foreachBatch``; it is exact, and no operator holds all keys of a window in
one row. (Spark keeps one count per key and window in its state store.)

Each micro-batch is written to ``<sink>/batch=<id>`` with overwrite, so a
replayed batch id replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.intervals import interval_str, interval_us
from ..functions.timebucket import instant_to_ntz, ntz_to_instant
from ..operators.topn import top_n


def event_time(df: DataFrame, ts: str, delay: str = "0 seconds", out: str = "_et") -> DataFrame:
    """Watermarked event-time column (``timestamp``; ``withWatermark`` rejects ``timestamp_ntz``).

    A ``timestamp_ntz`` input is mapped zone-independently (wall clock read as UTC).
    """
    et = ntz_to_instant(F.col(ts)) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else F.col(ts)
    return df.withColumn(out, et).withWatermark(out, delay)


def window_counts_stream(events: DataFrame, keys, et: str, size, slide,
                         count_col: str = "n") -> DataFrame:
    """Append-mode counts per key and sliding window; ``window_end`` as ``timestamp_ntz``.

    Two chained aggregations: events are counted per pane (the greatest common
    divisor of size and slide), closed panes are summed per window. So the
    fan-out to windows is per pane and key and not per event.

    ``et`` is a watermarked event-time column (see :func:`event_time`). Put the
    watermark before any filter, so that every row -- including rows the
    filter drops -- moves event time forward.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = interval_us(size), interval_us(slide)
    pane_us = gcd(size_us, slide_us)
    panes = (events.groupBy(*keys, F.window(et, interval_str(pane_us)).alias("_p"))
             .agg(F.count(F.lit(1)).alias("_n")))
    agg = (panes.select(*keys, F.window_time("_p").alias("_pt"), "_n")
           .groupBy(*keys, F.window("_pt", interval_str(size_us), interval_str(slide_us)).alias("_w"))
           .agg(F.sum("_n").alias(count_col)))
    return agg.select(*keys, instant_to_ntz(F.col("_w.end")).alias("window_end"), count_col)


def top_n_per_batch(sink: str, n: int, ties=None, order: str = "n", group: str = "window_end"):
    """``foreachBatch`` function writing the top ``n`` of each closed window."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (top_n(batch, group, order, n, ties=ties)
         .write.mode("overwrite").parquet(f"{sink}/batch={batch_id}"))
    return write
