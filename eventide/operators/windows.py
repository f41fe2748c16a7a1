"""Sliding event-time window counts.

Two plans compute the same result:

* ``method="window"`` -- Spark's ``window(ts, size, slide)``: every input row
  is expanded into ``size/slide`` windows before aggregation.
* ``method="panes"`` (default) -- count per key and *pane* of length
  ``g = gcd(size, slide)`` first (partial aggregation map-side, so only one
  row per key and pane crosses the shuffle), then add each pane count to
  every window containing the pane. A pane ``[p, p+g)`` lies in
  ``[s, s+size)`` exactly when ``s <= p < s+size`` because ``s``, ``size``
  and ``p`` are multiples of ``g``, so the result equals the first plan row
  for row. The windows of a pane are generated by exploding the window
  offsets ``0 .. ceil(size/slide)-1`` from the last window start at or before
  the pane: one small array per pane instead of the ``size/slide``-way
  ``Expand`` of ``window()``, which at 120 windows no longer compiles into
  whole-stage code. The fan-out (12x for 1 h/5 min, 120x for 10 min/5 s)
  happens after pre-aggregation and after the shuffle: pane counts are
  hash-partitioned by ``(key, time bucket)`` (a pane near a bucket end is
  copied into the next bucket too), and each partition generates and sums
  its windows locally. Only pane counts cross the network, and a hot key is
  spread over its buckets. Window arithmetic runs on bigint microseconds,
  converted from and to timestamps once per pane and once per output row.

Windows are half open ``[start, end)``; an event exactly on a slide boundary
belongs to the windows starting there. Only windows holding at least one row
are produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import interval_str, interval_us, pane_us
from ..functions.timebucket import epoch_of


DEFAULT_SPLIT = "1 day"


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sliding_counts(df: DataFrame, keys, ts: str, size, slide,
                   method: str = "panes", count_col: str = "n",
                   with_start: bool = False, weight: str | None = None,
                   split=None) -> DataFrame:
    """Rows per key and sliding window.

    Returns ``keys..., [window_start], window_end, <count_col>`` (count is a
    bigint). ``size``/``slide`` are interval strings, seconds or timedeltas.
    ``weight`` names a column of pre-counted rows (for instance the output of
    :func:`pane_counts` joined to a lookup) to add instead of counting rows.
    ``split`` is the time-bucket length of the pane plan (default one day,
    never less than ``size``).
    """
    keys = _names(keys)
    size_s = interval_str(interval_us(size))
    slide_s = interval_str(interval_us(slide))
    measure = F.sum(weight) if weight else F.count(F.lit(1))
    if method == "window":
        agg = (df.groupBy(*keys, F.window(ts, size_s, slide_s).alias("_w"))
                 .agg(measure.cast("bigint").alias(count_col)))
        cols: list[Column] = [F.col(k) for k in keys]
        if with_start:
            cols.append(F.col("_w.start").alias("window_start"))
        cols += [F.col("_w.end").alias("window_end"), F.col(count_col)]
        return agg.select(*cols)
    if method != "panes":
        raise ValueError(f"unknown method {method!r}")
    size_us, slide_us, g_us = interval_us(size), interval_us(slide), pane_us(size, slide)
    bucket_us = max(size_us, interval_us(split or DEFAULT_SPLIT))
    panes = (df.groupBy(*keys, F.window(ts, interval_str(g_us)).start.alias("_pane"))
               .agg(measure.alias("_pn")))

    tdt = panes.schema["_pane"].dataType
    epoch = epoch_of(tdt)

    def floor_us(c, width):
        return c - F.pmod(c, F.lit(width))

    # From here on time is a bigint of microseconds: converted once per pane
    # and once per output row, never per (pane, window) pair.
    p_us = panes.select(*keys, "_pn", F.timestamp_diff("MICROSECOND", epoch, F.col("_pane")).alias("_p"))
    # Window ends of a pane lie in (p, p + size]; with buckets at least `size`
    # long that is one bucket or two neighbours.
    first = floor_us(F.col("_p") + F.lit(g_us), bucket_us)
    last = floor_us(F.col("_p") + F.lit(size_us), bucket_us)
    # With the session's own partition number adaptive execution does not merge the
    # tasks by the small size of the panes: the fan-out to windows follows.
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (p_us.withColumn("_b", F.explode(F.array_distinct(F.array(first, last))))
                  .repartition(n_parts, *keys, "_b"))
    n_windows = -(-size_us // slide_us)
    offsets = F.sequence(F.lit(0).cast("bigint"), F.lit(n_windows - 1).cast("bigint"))
    ends = (spread.select(*keys, "_b", "_pn", "_p", F.explode(offsets).alias("_i"))
                  .select(*keys, "_b", "_pn", "_p",
                          (floor_us(F.col("_p"), slide_us) + F.lit(size_us)
                           - F.col("_i") * F.lit(slide_us)).alias("_we"))
                  .where((F.col("_we") > F.col("_p")) & (F.col("_we") >= F.col("_b"))
                         & (F.col("_we") < F.col("_b") + F.lit(bucket_us))))
    # Grouping by (keys, _b, _we) reuses the (keys, _b) partitioning:
    # no second exchange of the fanned-out rows.
    agg = ends.groupBy(*keys, "_b", "_we").agg(F.sum("_pn").cast("bigint").alias(count_col))
    cols = [F.col(k) for k in keys]
    if with_start:
        cols.append(F.timestamp_add("MICROSECOND", F.col("_we") - F.lit(size_us), epoch).alias("window_start"))
    return agg.select(*cols, F.timestamp_add("MICROSECOND", F.col("_we"), epoch).alias("window_end"),
                      count_col)


def pane_counts(df: DataFrame, keys, ts: str, pane) -> DataFrame:
    """Tumbling count per key and pane: ``keys..., pane_start, n``."""
    keys = _names(keys)
    return (df.groupBy(*keys, F.window(ts, interval_str(interval_us(pane))).start.alias("pane_start"))
              .agg(F.count(F.lit(1)).alias("n")))
