"""Streaming sequence patterns: C1 and C2 with the batch pattern per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import interval_us
from ..functions.timebucket import epoch_of
from ..operators.sequence import adjacent_change, followed_by_within
from ..session import drop_folder, finished_ids

NO_TIME = -(1 << 62)     # event time before any row, in microseconds


def followed_by_per_batch(root: str, key: str, ts: str, seq: str, is_start: Column, is_end: Column, within,
                          cols=(), delay: str = "0 seconds", split="segments", emit=None):
    """``foreachBatch`` function of C2: the batch pattern over carried rows and the micro-batch.

    Event time is the newest ``ts`` of any row so far less ``delay``. A start is
    emitted once: as ``paid`` in the micro-batch in which event time passes its end
    (no nearer end can come any more), as ``timeout`` when event time has reached
    ``start + within``, at once if it has no ``ts``. Rows behind the event time of
    earlier batches are late and dropped; rows with a NULL key are ignored. Only
    starts not yet emitted and ends younger than ``within`` are carried, so no start
    meets more than its nearest end: linear, and a hot key is cut into segments by
    ``split``.

    Folders under ``root``, named by batch id: ``out`` (unless ``emit(rows,
    batch_id)`` writes the results), ``open`` (carried rows) and ``mark`` (event
    time, written last). A replayed batch starts again from the batch before it
    and overwrites its own folders.
    """
    within_us, delay_us, cols = interval_us(within), interval_us(delay, zero=True), list(cols)

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        position = lambda c: F.timestamp_diff("MICROSECOND", epoch_of(batch.schema[ts].dataType), F.col(c))
        flag = lambda c: F.coalesce(c, F.lit(False))
        rows = batch.select(key, ts, seq, *cols, flag(is_start).alias("_start"), flag(is_end).alias("_end"),
                            position(ts).alias("_at")).persist()
        try:
            before = [i for i in finished_ids(spark, f"{root}/mark", "batch") if i < batch_id]
            carried, mark = None, NO_TIME
            if before:
                carried = spark.read.schema(rows.schema).parquet(f"{root}/open/batch={before[-1]}")
                mark = spark.read.parquet(f"{root}/mark/batch={before[-1]}").first()["mark"]
            newest = rows.agg(F.max("_at")).first()[0]
            now = mark if newest is None else max(mark, newest - delay_us)
            fresh = rows.where(F.col(key).isNotNull() & (F.col("_start") | F.col("_end"))
                               & (F.col("_at").isNull() | (F.col("_at") >= mark)))
            known = fresh if carried is None else carried.unionByName(fresh)
            found = followed_by_within(known, key, ts, seq, F.col("_start"), F.col("_end"), within,
                                       cols=[*cols, "_end"], split=split).persist()
            start, end = position(f"start_{ts}"), position(f"end_{ts}")
            due = start.isNull() | (start + within_us <= now) | F.coalesce(end < now, F.lit(False))
            (emit or save)(found.where(due).drop("start__end", "end__end"), batch_id)
            # A start that stays open keeps its row; an emitted one that is an end too stays as an end.
            again = found.where(start + within_us > now).where(~due | F.col("start__end"))
            again = again.select(key, *[F.col(f"start_{c}").alias(c) for c in (ts, seq, *cols)], (~due).alias("_start"),
                                 F.col("start__end").alias("_end"), start.alias("_at"))
            ends = known.where(~F.col("_start") & F.col("_end") & (F.col("_at") + within_us > now))
            ends.unionByName(again).write.mode("overwrite").parquet(f"{root}/open/batch={batch_id}")
            found.unpersist()
            spark.range(1).select(F.lit(now).cast("bigint").alias("mark")).write.mode("overwrite").parquet(
                f"{root}/mark/batch={batch_id}")
        finally:
            rows.unpersist()
        for old in before[:-1]:                    # a replay needs the batch before it, no older one
            drop_folder(spark, f"{root}/open/batch={old}")
            drop_folder(spark, f"{root}/mark/batch={old}")
    return write


STATE_BUCKETS = 16       # folders that the last events are dealt into by key
MERGE_EVERY = 16         # micro-batches whose last events are merged into one full state


class LastEvents:
    """The last event of every key, kept as a log of per-batch rows dealt into buckets by key.

    Folders under ``root``: ``last/batch=<id>/_bucket=<b>``, the last events of the
    keys of one micro-batch, and, every ``merge_every`` micro-batches,
    ``state/batch=<id>/_bucket=<b>``, those of all keys so far. A lookup merges the
    newest full state with the rows after it, in the buckets of the wanted keys
    alone. A micro-batch so writes its own keys, whatever the number of known ones.
    """

    def __init__(self, root: str, key: str, buckets: int = STATE_BUCKETS, merge_every: int = MERGE_EVERY):
        self.root, self.key, self.buckets, self.merge_every = root, key, buckets, merge_every

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def before(self, rows: DataFrame, batch_id: int, wanted: list[int] | None = None) -> DataFrame | None:
        """Last events (columns of ``rows``) as of the micro-batch before ``batch_id``, of the ``wanted`` buckets or all."""
        spark, found = rows.sparkSession, None
        full = [i for i in finished_ids(spark, f"{self.root}/state", "batch") if i < batch_id]
        since = full[-1] if full else -1
        parts = [f"{self.root}/state/batch={since}"] if full else []
        parts += [f"{self.root}/last/batch={i}" for i in finished_ids(spark, f"{self.root}/last", "batch") if since < i < batch_id]
        for path in parts:
            part = spark.read.schema(f"{_ddl(rows)}, _bucket int, _batch bigint").parquet(path)
            found = part if found is None else found.unionByName(part)
        if found is None:
            return None
        if wanted is not None:
            found = found.where(F.col("_bucket").isin(wanted))
        rest = [c for c in rows.columns if c != self.key]
        newest = found.groupBy(self.key).agg(F.max_by(F.struct(*rest), "_batch").alias("_e"))
        return newest.select(self.key, *[F.col(f"_e.{c}").alias(c) for c in rest])

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Keep ``rows``, one a key, as the last events of micro-batch ``batch_id``; written again on a replay."""
        spark = rows.sparkSession
        self._write(rows.withColumn("_batch", F.lit(batch_id).cast("bigint")), f"{self.root}/last/batch={batch_id}")
        done = [i for i in finished_ids(spark, f"{self.root}/state", "batch") if i < batch_id]
        if len([i for i in finished_ids(spark, f"{self.root}/last", "batch") if i > (done[-1] if done else -1)]) >= self.merge_every:
            full = self.before(rows, batch_id + 1)
            self._write(full.withColumn("_batch", F.lit(batch_id).cast("bigint")), f"{self.root}/state/batch={batch_id}")
            for old in done[:-1]:                  # a replay of this micro-batch starts from the state before it
                drop_folder(spark, f"{self.root}/state/batch={old}")
            for old in finished_ids(spark, f"{self.root}/last", "batch"):
                if done and old <= done[-1]:
                    drop_folder(spark, f"{self.root}/last/batch={old}")

    def _write(self, rows: DataFrame, path: str) -> None:
        (rows.withColumn("_bucket", self.bucket()).repartition("_bucket")
         .write.mode("overwrite").partitionBy("_bucket").parquet(path))


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def adjacent_change_per_batch(root: str, key: str, order: list[str], value: str, cols=(), split="segments",
                              buckets: int = STATE_BUCKETS, merge_every: int = MERGE_EVERY):
    """``foreachBatch`` function of C1: the batch pattern over each key's last event and the micro-batch.

    Arrival order across micro-batches is the order of the batches; within one,
    a key's rows go by ``order``. Rows with a NULL key are ignored. The event
    carried for a key is compared with the key's first row of the batch only, so
    a row that sorts before it is still its successor. A hot key is cut into
    segments by ``split``. Output columns equal
    :func:`~eventide.operators.sequence.adjacent_change`.

    Folders under ``root``: ``out``, named by batch id, and those of :class:`LastEvents`.
    A replayed batch starts again from the batch before it and overwrites its own
    folders.
    """
    order, cols = list(order), list(cols)
    carried = [c for c in dict.fromkeys(order + [value] + cols) if c != key]
    state = LastEvents(root, key, buckets, merge_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col(key).isNotNull()).select(key, *carried).persist()
        try:
            event, at = F.struct(*carried), F.struct(*order)
            ends = rows.groupBy(key).agg(F.min_by(event, at).alias("_first"), F.max_by(event, at).alias("_last")).persist()
            wanted = [r[0] for r in ends.select(state.bucket()).distinct().collect()]          # at most ``buckets``
            found = adjacent_change(rows, key, order, value, cols=cols, split=split)
            known = state.before(rows, batch_id, wanted)
            if known is not None:
                joint = ends.join(known.select(key, event.alias("_before")), key).where(
                    ~F.col(f"_first.{value}").eqNullSafe(F.col(f"_before.{value}")))
                found = found.unionByName(joint.select(key, *[F.col(f"_first.{c}").alias(c) for c in carried],
                                                       *[F.col(f"_before.{c}").alias(f"prev_{c}") for c in carried]))
            found.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")
            state.append(ends.select(key, *[F.col(f"_last.{c}").alias(c) for c in carried]), batch_id)
            ends.unpersist()
        finally:
            rows.unpersist()
    return write
