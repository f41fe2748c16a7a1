"""Running streaming queries (E6, E7) and staging ordered input files for tests."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB (spills to local disk, checkpointed remotely).

    Takes effect for queries started afterwards from a fresh checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_stream(df: DataFrame, checkpoint: str, sink: str | None = None, fmt: str = "parquet",
               foreach_batch=None, output_mode: str = "append", trigger: dict | None = None,
               query_name: str | None = None, options: dict | None = None,
               partition_by: list[str] | None = None) -> StreamingQuery:
    """Start ``df`` with a durable checkpoint.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "60 seconds"}`` for the ETL job's interval, or
    ``{"availableNow": True}`` to drain what exists and stop). Either
    ``foreach_batch`` (a function ``(batch_df, batch_id)``) or a ``sink`` path
    in ``fmt`` is used.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.format(fmt).start(sink)


def stage_by_time(df: DataFrame, ts: str, path: str, slices: int, files_per_slice: int) -> int:
    """Replay harness: write ``df`` to ``path`` as ``slices`` time slices, one after another.

    Later slices get later file modification times, the order in which the
    file stream source reads files. Every slice is a distributed write of
    exactly ``files_per_slice`` files (round-robin), so reading with
    ``maxFilesPerTrigger=files_per_slice`` makes each micro-batch one slice
    and no row arrives behind the watermark of an earlier batch. Returns the
    ``maxFilesPerTrigger`` value to use.
    """
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:                                  # no row has a time: one slice
        df.repartition(files_per_slice).write.mode("append").parquet(path)
        return files_per_slice
    step = (hi - lo) / slices
    bounds = [lo + step * i for i in range(slices)] + [hi]
    for i in range(slices):
        cond = (F.col(ts) >= bounds[i]) & ((F.col(ts) < bounds[i + 1]) if i < slices - 1 else F.lit(True))
        if i == 0:
            cond = cond | F.col(ts).isNull()         # rows without a time come first, as they sort
        df.where(cond).repartition(files_per_slice).write.mode("append").parquet(path)
    return files_per_slice


def stage_by_count(df: DataFrame, ts: str, path: str, slices: int, files_per_slice: int) -> int:
    """As :func:`stage_by_time`, with slices of about equally many rows, however the times lie.

    The rows are dealt to folders of their slices in one pass, so the work does
    not grow with rows times slices. Rows of one time stay in one slice.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(df.agg(F.percentile_approx(us, F.array(*map(F.lit, shares)), 100 * slices)).first()[0] or []))
    if not cuts:                                    # no row has a time: one slice
        df.repartition(files_per_slice).write.mode("append").parquet(path)
        return files_per_slice
    at = F.coalesce(us, F.lit(cuts[0] - 1))         # rows without a time come first, as they sort
    of = F.aggregate(F.array(*map(F.lit, cuts)), F.lit(0), lambda n, cut: n + (at >= cut).cast("int"))
    dealt = f"{path}-dealt"
    sliced = df.withColumn("_slice", of)
    sliced.write.partitionBy("_slice").parquet(dealt)
    rows = df.sparkSession.read.schema(sliced.schema).parquet(dealt)
    for i in range(len(cuts) + 1):
        (rows.where(F.col("_slice") == i).drop("_slice").repartition(files_per_slice)
             .write.mode("append").parquet(path))
    return files_per_slice


def append_markers(markers, path: str, files_per_batch: int) -> None:
    """Append end-of-input rows (far-future events) as the last two micro-batches.

    ``markers(k)`` returns the marker rows of batch ``k`` (at least
    ``files_per_batch`` rows, so the batch fills exactly that many files).
    A bounded replay has no end-of-stream signal: the first marker batch
    moves the watermark past every real window and pattern bound, the second
    makes Spark emit them (results are emitted by the batch after the one
    that moved the watermark). Callers exclude markers from results.
    """
    for k in (0, 1):
        markers(k).repartition(files_per_batch).write.mode("append").parquet(path)


def split_outputs_per_batch(outputs: dict):
    """``foreachBatch`` function writing one micro-batch to several sinks (K5).

    ``outputs`` maps a sink path to ``(predicate Column, [columns])``. The
    batch is persisted once so every sink reads the same rows without
    recomputing the batch; each sink folder is ``<path>/batch=<id>``,
    overwritten on replay.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            for path, (pred, cols) in outputs.items():
                (b.where(pred).select(*cols)
                  .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))
        finally:
            b.unpersist()
    return write


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Start streaming queries with at most ``n`` shuffle (= state store) partitions.

    A stateful query keeps the partition count it first started with (it is
    stored in the checkpoint) and touches every state store in every
    micro-batch. The bounded replays use no more partitions than there are
    task slots (``defaultParallelism``); the session setting is restored.
    """
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    n = n or spark.sparkContext.defaultParallelism
    spark.conf.set(key, str(max(1, min(int(old), n))))
    try:
        yield
    finally:
        spark.conf.set(key, old)
