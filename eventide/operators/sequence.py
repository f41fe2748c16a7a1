"""Sequence patterns over keyed events.

Both patterns need the events of one key in order. A plain
``Window.partitionBy(key)`` sends all of a key's events to one task, which is
fine for ordinary keys but not when one key holds a large share of the data.
With ``split=<interval>`` the work is partitioned by ``(key, time bucket)``
instead and the few rows that need a neighbour from another bucket get it
through a small per-bucket table, so results are exactly the unsplit ones.

``split="segments"`` cuts the sequence of a hot key at sampled rows instead of
times (see :func:`segments`), so it also cuts a burst within a pattern's bound and
order columns that are neither times nor integers; neighbours in another segment
come from one summary per segment, its last event for C1, its first end for C2.

``split="auto"`` picks the bucket length from the data (see
:func:`auto_split`): no split while no key is hot, else about a million rows
per (key, bucket), never shorter than the pattern's bound. Rows without a time
have a bucket of their own, so no split loses them.

Order within a key is ``order`` (e.g. ``["ts", "event_id"]``); it must be a
total order per key (carry an arrival sequence when timestamps can tie).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.intervals import interval_us
from ..functions.timebucket import epoch_of


def _names(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


# split="auto" aims at about this many rows per (key, time bucket) group.
AUTO_SPLIT_ROWS = 1_000_000
# Bucket of rows without a position: before all others, as NULLs sort first.
NULL_BUCKET = -(1 << 62)


def _position(df: DataFrame, col: str) -> Column | None:
    """``col`` as a bigint to cut into buckets: microseconds or the number itself; else None."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", epoch_of(kind), F.col(col))
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("bigint")
    return None


def _bucket(position: Column, length: int) -> Column:
    """Bucket number of a position; NULL positions share the first bucket."""
    whole = F.floor((position - F.pmod(position, F.lit(length))) / F.lit(length)).cast("bigint")
    return F.coalesce(whole, F.lit(NULL_BUCKET))


def auto_split(df: DataFrame, keys, position: Column, min_length: int = 1,
               target_rows: int = AUTO_SPLIT_ROWS) -> int | None:
    """Bucket length that cuts every hot key into groups of about ``target_rows`` rows.

    None when no key has more rows than that: one aggregation, no split. Else
    the length shrinks until the largest (key, bucket) group fits, so a burst is
    cut as well, but never below ``min_length``; these aggregations read the hot
    keys only.
    """
    keys = _names(keys)
    p = df.select(*keys, position.alias("_p"))
    per_key = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    hot = per_key.where(F.col("_n") > target_rows)
    r = hot.agg(F.max("_n").alias("n"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).first()
    if r["n"] is None or r["lo"] is None:
        return None
    length = max(min_length, (r["hi"] - r["lo"] + 1) // -(-r["n"] // target_rows))
    rows = p.join(hot.select(*keys), keys, "left_semi").where("_p IS NOT NULL")
    while length > min_length:
        worst = rows.groupBy(*keys, _bucket(F.col("_p"), length).alias("_b")).count().agg(F.max("count")).first()[0] or 0
        if worst <= target_rows:
            break
        length = max(min_length, length // max(2, 2 * worst // target_rows))
    return length


SEGMENT_ROWS = 1_000_000      # rows of a segment, more where that would give over MAX_CUTS cuts
MAX_CUTS = 4096
SAMPLES = 50                  # sampled rows of a segment
_FINE = 64


def segments(df: DataFrame, keys, order) -> DataFrame | None:
    """``keys, _cuts``: for every hot key the ``order`` values that cut its rows into segments; else None.

    Rows are sampled by a hash of key and order, ``SAMPLES`` a segment, and every
    ``SAMPLES``-th sampled row of a key is a cut. A cut stands for at least one
    ``MAX_CUTS``-th of the rows, so about ``MAX_CUTS`` cuts at most are held, whatever
    the size: the result is a broadcast table. No key is counted.
    """
    keys, order = _names(keys), _names(order)
    total = df.count()
    if total <= SEGMENT_ROWS:
        return None
    rate = SAMPLES / max(SEGMENT_ROWS, total // MAX_CUTS)
    at = F.struct(*order)
    drawn = F.pmod(F.xxhash64(*keys, *order), F.lit(1 << 30)) < int(min(1.0, rate) * (1 << 30))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    cuts = (df.select(*keys, at.alias("_at")).where(drawn).withColumn("_i", place).where(F.col("_i") % SAMPLES == 0)
            .groupBy(*keys).agg(F.sort_array(F.collect_list("_at")).alias("_cuts")))
    found = cuts.collect()
    return F.broadcast(df.sparkSession.createDataFrame(found, cuts.schema)) if found else None


def _in_segments(df: DataFrame, keys: list[str], order: list[str], cuts: DataFrame) -> DataFrame:
    """``df`` with ``_b``, the number of the row's segment: its key's cuts at or before it, found in two steps."""
    at = F.struct(*order)
    upto = lambda some: F.size(F.filter(some, lambda c: c <= at))
    coarse = upto(F.transform(F.sequence(F.lit(1), F.floor(F.size("_cuts") / _FINE).cast("int")),
                              lambda i: F.element_at("_cuts", i * _FINE)))
    coarse = F.when(F.size("_cuts") >= _FINE, coarse).otherwise(0)
    marked = df.join(cuts, keys, "left").withColumn("_c", coarse)
    fine = upto(F.slice("_cuts", F.col("_c") * _FINE + 1, F.lit(_FINE)))
    b = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.col("_c") * _FINE + fine)
    return marked.withColumn("_b", b.cast("bigint")).drop("_cuts", "_c")


def _resolve_split(df: DataFrame, keys, position: Column, split, min_length: int = 1) -> int | None:
    if split is None:
        return None
    return auto_split(df, keys, position, min_length) if split == "auto" else interval_us(split)


def with_previous(df: DataFrame, keys, order, cols, split=None, ts: str | None = None,
                  prev: str = "prev") -> DataFrame:
    """Add struct column ``prev`` = (``order`` + ``cols``) of the previous row of the key.

    ``split`` cuts each key's sequence into segments (``"segments"``) or buckets of the
    first ``order`` column (a timestamp or an integer; any other is not split). ``ts`` names the column
    that a time length is meant for: if that is not the first order column, the
    length comes from the data as with ``"auto"``. The first row of a bucket takes the last row of the nearest earlier non-empty
    bucket of its key. The per-bucket last rows come from a second, narrow
    read of the input aggregated map-side with ``max_by`` (one row per key and
    bucket per task crosses the shuffle). Taking them from the window output
    instead was measured to shuffle every row twice: Spark does not reuse the
    exchange across the self-join.
    """
    keys, order, cols = _names(keys), _names(order), _names(cols)
    payload = F.struct(*[F.col(c) for c in dict.fromkeys(order + cols)])
    cuts = segments(df, keys, order) if split == "segments" else None
    position = None if split == "segments" else _position(df, order[0])
    if position is not None and split not in (None, "auto") and ts not in (None, order[0]):
        split = "auto"                    # a time length says nothing about another order
    length = None if position is None else _resolve_split(df, keys, position, split)
    if length is None and cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(prev, F.lag(payload).over(w))
    b = df.withColumn("_b", _bucket(position, length)) if cuts is None else _in_segments(df, keys, order, cuts)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    inner = b.withColumn(prev, F.lag(payload).over(w))
    # Last row of every (key, bucket), then the previous non-empty bucket's last
    # row per key: one row per key and bucket, so this window stays small.
    last = (b.groupBy(*keys, "_b")
              .agg(F.max_by(payload, F.struct(*order)).alias("_last")))
    carry = (last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")))
                 .select(*keys, "_b", "_carry"))
    return (inner.join(carry, keys + ["_b"], "left")
                 .withColumn(prev, F.coalesce(F.col(prev), F.col("_carry")))
                 .drop("_carry", "_b"))


def adjacent_change(df: DataFrame, keys, order, value: str, cols=(), split=None,
                    ts: str | None = None) -> DataFrame:
    """Pairs of consecutive events of a key whose ``value`` differs.

    Rows with a NULL key are ignored (filtered before pairing, so they do not
    break adjacency). Every event is compared with the one just before it, so
    values A,B,A,A give two alerts (at B and at the second A). NULL vs a
    value counts as a change. Output: the second event's columns plus
    ``prev_<c>`` for the first event's ``order``, ``value`` and ``cols``.
    """
    keys, order, cols = _names(keys), _names(order), _names(cols)
    carried = list(dict.fromkeys(order + [value] + cols))
    base = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    base = base.select(*dict.fromkeys(keys + carried))
    p = with_previous(base, keys, order, [value] + cols, split=split, ts=ts, prev="_prev")
    hit = p.where(F.col("_prev").isNotNull()
                  & ~F.col(value).eqNullSafe(F.col(f"_prev.{value}")))
    return hit.select(*keys, *[F.col(c) for c in carried if c not in keys],
                      *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in carried])


def followed_by_within(df: DataFrame, keys, ts: str, seq: str, is_start: Column,
                       is_end: Column, within, cols=(), as_of=None, split=None) -> DataFrame:
    """For every start event, the first later end event of its key within ``within``.

    "Later" means greater ``(ts, seq)``; events that are neither start nor end
    are skipped. A start is ``paid`` when that first later end has
    ``end.ts < start.ts + within`` (strict). Otherwise it is ``timeout`` --
    or ``pending`` when ``as_of`` is given and ``start.ts + within > as_of``
    (the bound has not passed yet). Two starts before one end both match it;
    one start before two ends matches the first only; an end with no start
    gives nothing. Rows with a NULL key are ignored; a start without ``ts`` is a
    ``timeout`` and an end without it matches nothing.

    Output: ``keys``, ``start_<seq>``, ``start_<ts>``, ``start_<c>`` for
    ``cols``, ``end_<seq>``, ``end_<ts>``, ``end_<c>`` (NULL unless paid) and
    ``status``.

    Plan: one sort per key (or per key and time bucket with ``split``). Rows
    are scanned newest first with a growing frame, so ``last(end,
    ignorenulls)`` over the rows already seen is the nearest later end --
    linear, no self join. With ``split`` (at least ``within``) each end row is
    also copied into the previous bucket when it lies within ``within`` of its
    bucket start, which is every end a start of that bucket can match. With
    ``split="segments"`` a start without a later end in its segment takes the first
    end of the next segments that have one, from a table of one row per segment.
    """
    keys, cols = _names(keys), _names(cols)
    within_us = interval_us(within)
    ev = (df.where((is_start | is_end) & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .select(*keys, ts, seq, *cols, is_start.alias("_s"), is_end.alias("_e")))
    part = list(keys)
    cuts = None
    if split == "segments":
        cuts, split = segments(ev, keys, [ts, seq]), None
    position = _position(ev, ts)
    split_us = _resolve_split(ev, keys, position, split, min_length=within_us)
    if split_us is not None:
        if split_us < within_us:
            raise ValueError("split must be at least as long as within")
        b = _bucket(position, split_us)
        prev_b = F.col("_b") - 1
        near_start = position - F.col("_b") * F.lit(split_us) < F.lit(within_us)
        ev = (ev.withColumn("_b", b)
                .withColumn("_own", F.lit(True))
                .withColumn("_bs", F.when(F.col("_e") & near_start, F.array(F.col("_b"), prev_b))
                                     .otherwise(F.array(F.col("_b"))))
                .withColumn("_bb", F.explode("_bs"))
                .withColumn("_own", F.col("_bb") == F.col("_b"))
                .drop("_b", "_bs").withColumnRenamed("_bb", "_b"))
        part.append("_b")
    else:
        ev = ev.withColumn("_own", F.lit(True))
    end_payload = F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"), *[F.col(c) for c in cols])
    w = (Window.partitionBy(*part).orderBy(F.col(ts).desc(), F.col(seq).desc())
               .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.last(F.when(F.col("_e"), end_payload), ignorenulls=True).over(w)
    if cuts is None:
        starts = ev.withColumn("_n", nxt).where(F.col("_s") & F.col("_own"))
    else:
        ev = _in_segments(ev, keys, [ts, seq], cuts)
        firsts = ev.groupBy(*keys, "_b").agg(F.min_by(F.when(F.col("_e"), end_payload), F.when(F.col("_e"), F.struct(ts, seq))).alias("_end"))
        later = Window.partitionBy(*keys).orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
        firsts = firsts.select(*keys, "_b", F.first("_end", ignorenulls=True).over(later).alias("_later"))
        w = (Window.partitionBy(*keys, "_b").orderBy(F.col(ts).desc(), F.col(seq).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
        nxt = F.last(F.when(F.col("_e"), end_payload), ignorenulls=True).over(w)
        starts = (ev.withColumn("_n", nxt).where("_s").join(firsts, [*keys, "_b"], "left")
                  .withColumn("_n", F.coalesce("_n", "_later")).drop("_later"))
    deadline = F.expr(f"timestampadd(MICROSECOND, {within_us}, `{ts}`)")
    paid = F.col("_n").isNotNull() & (F.col("_n.t") < deadline)
    status = F.when(paid, F.lit("paid"))
    if as_of is not None:
        as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
        status = status.when(deadline > as_of_col, F.lit("pending"))
    status = status.otherwise(F.lit("timeout"))
    return starts.select(
        *keys,
        F.col(seq).alias(f"start_{seq}"), F.col(ts).alias(f"start_{ts}"),
        *[F.col(c).alias(f"start_{c}") for c in cols],
        F.when(paid, F.col("_n.s")).alias(f"end_{seq}"),
        F.when(paid, F.col("_n.t")).alias(f"end_{ts}"),
        *[F.when(paid, F.col(f"_n.{c}")).alias(f"end_{c}") for c in cols],
        status.alias("status"))
