"""Streaming writes of the upsert table's change log (U2, U4) and the streaming read.

Two ways to write, one for each need:

* :func:`append_changes`: the stream's rows go through Spark's own file sink. A
  micro-batch counts when the sink has listed its files in ``log/_spark_metadata``,
  in one step; files of a broken-off micro-batch are never listed, and its replay
  writes others. Batch readers and :func:`stream_changes` go by that list, so every
  change reaches them once. The commit number is a column of the input.
* :func:`upsert_per_batch`: a ``foreachBatch`` function for batches that must be
  prepared as a whole. Micro-batch ``b`` becomes commit folder ``b + 1``; a finished
  commit is not written again. It has batch readers only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import SINK_LOG, log_rows, upsert
from ..session import path_exists
from .runner import run_stream


def append_changes(changes: DataFrame, path: str, checkpoint: str, keys, commit: Column, op_col: str | None = None,
                   seq: str | None = None, trigger: dict | None = None,
                   partition: str | None = None) -> StreamingQuery:
    """Start a query that appends the streaming ``changes`` to the log of the table at ``path``, exactly once.

    ``commit`` numbers the producer's commits and must come from the rows (a column
    of theirs, the time of their file), so that a replay numbers them alike. A NULL
    key fails the query. ``partition`` (a column of low cardinality, such as a day)
    gives the files folders of their own, which readers can skip.
    """
    return run_stream(log_rows(changes, keys, commit, op_col, seq), checkpoint, sink=f"{path}/log", trigger=trigger,
                      partition_by=[partition] if partition else None)


def upsert_per_batch(path: str, keys, partition: str, op_col: str | None = None, seq: str | None = None,
                     prepare: Callable[[DataFrame, int], DataFrame] | None = None):
    """``foreachBatch`` function writing each micro-batch, after ``prepare``, as one commit."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch, batch_id)
        upsert(batch.sparkSession, path, rows, batch_id + 1, keys, partition, op_col=op_col, seq=seq)
    return write


def stream_changes(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The change log of a table written by :func:`append_changes`, as a stream: each change once.

    Schema is taken from the commits present when the stream is defined. Use
    ``trigger(processingTime="3 seconds")`` for a check interval.
    """
    if not path_exists(spark, f"{path}/log/{SINK_LOG}"):
        raise ValueError(f"{path}/log was not written by append_changes; commit folders have batch readers only")
    r = spark.readStream.schema(spark.read.parquet(f"{path}/log").schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{path}/log")
