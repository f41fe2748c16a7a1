"""Keyed upsert table as a log of changes on plain Parquet.

Layout under ``path``: ``log/evt_commit=<n>/*.parquet``, one folder per commit.
Every stored row carries the table columns plus ``_op``, ``_commit`` and
``_seq`` (arrival order within the commit). ``_op`` is ``D`` or ``-D`` for a
delete and ``-U`` for a retraction, which is logged but never a table row; any
other value upserts.

* upsert: write all change rows of a batch as commit ``n``, none left out; a
  finished commit is not written again, so replaying a batch id leaves the
  table unchanged.
* snapshot (merge on read): one winner per key by ``(ordering, _commit, _seq)``
  over the finished commits, deleted winners dropped. A row older than the
  stored one therefore never replaces it, and a key that moves to another day
  appears once, in its new day.
* changes since: the log rows of later commits, all kinds.
* a reader that has merged the log up to some commit can keep the result
  (:func:`merge_changes`, written wherever it likes) and merge later commits
  onto it; deletes stay in it as tombstones, so the snapshot is the same.

A table fed by a stream alone can keep its log in Spark's file sink instead of commit
folders (:mod:`eventide.streaming.upsert`); the readers here take either.

One writer per table; readers use finished commits only, so they can run at any time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import finished_ids, path_exists
from .changes import DELETE, UPDATE_BEFORE, precombine

COMMIT_DIR = "evt_commit"
SINK_LOG = "_spark_metadata"     # where Spark's file sink lists the files of finished micro-batches
META = ["_op", "_commit", "_seq"]


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def upsert(spark: SparkSession, path: str, batch: DataFrame, commit: int, keys,
           partition: str, op_col: str | None = None, seq: str | None = None) -> None:
    """Write the change rows of ``batch`` as commit ``commit`` (U2). Idempotent per commit id.

    A finished commit is never written again, so a replay changes nothing that
    readers use; what a crash left of an unfinished one is replaced. A NULL key
    fails the write. Rows are not shuffled; every file is sorted by ``partition``.

    ``op_col`` (optional) holds the kind of change (see the module text).
    ``seq`` orders rows that tie on the ordering within the batch (later wins).
    """
    if int(commit) in finished_commits(spark, path):
        return
    (log_rows(batch, keys, F.lit(int(commit)), op_col, seq).sortWithinPartitions(partition)
     .write.mode("overwrite").parquet(f"{path}/log/{COMMIT_DIR}={int(commit)}"))


def log_rows(changes: DataFrame, keys, commit: Column, op_col: str | None = None, seq: str | None = None) -> DataFrame:
    """Change rows as the log stores them; a NULL key fails."""
    cols = [c for c in changes.columns if c != op_col]
    no_key = F.raise_error(F.lit("upsert: NULL key"))
    values = [F.when(F.col(c).isNull(), no_key).otherwise(F.col(c)).alias(c) if c in _keys(keys) else F.col(c) for c in cols]
    return changes.select(*values,
                          (F.coalesce(F.col(op_col).cast("string"), F.lit("U")) if op_col else F.lit("U")).alias("_op"),
                          commit.cast("bigint").alias("_commit"),
                          (F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")).alias("_seq"))


def finished_commits(spark: SparkSession, path: str) -> list[int]:
    """Ids of the commits whose write has ended."""
    return finished_ids(spark, f"{path}/log", COMMIT_DIR)


def read_log(spark: SparkSession, path: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Change rows of the finished commits ``after < n <= upto``; other folders are not read.

    A log written by :func:`eventide.streaming.upsert.append_changes` is read through
    its own list of committed files.
    """
    if path_exists(spark, f"{path}/log/{SINK_LOG}"):
        upto_col = F.lit(True) if upto is None else F.col("_commit") <= upto
        return spark.read.parquet(f"{path}/log").where((F.col("_commit") > after) & upto_col)
    done = finished_commits(spark, path)
    if not done:
        raise FileNotFoundError(f"no upsert table at {path}")
    ids = [i for i in done if i > after and (upto is None or i <= upto)]
    folders = [f"{path}/log/{COMMIT_DIR}={i}" for i in ids or done[:1]]
    log = spark.read.option("basePath", f"{path}/log").parquet(*folders).drop(COMMIT_DIR)
    return log if ids else log.limit(0)


def merge_changes(changes: DataFrame, keys, ordering, base: DataFrame | None = None) -> DataFrame:
    """Winning row per key of ``changes`` (log rows) and ``base`` (an earlier result), deletes included.

    One ``max_by`` aggregation, so the result depends on no size and a hot key
    combines map-side.
    """
    rows = changes.where(F.col("_op") != UPDATE_BEFORE)
    if base is not None:
        rows = base.unionByName(rows)
    return precombine(rows, keys, _keys(ordering) + ["_commit"], seq="_seq")


def read_snapshot(spark: SparkSession, path: str, keys, ordering, base: DataFrame | None = None,
                  after: int = 0) -> DataFrame:
    """Current table content (U3 / S6): table columns only.

    With ``base``, the merged rows of the commits up to ``after``, only later
    commits are read.
    """
    m = merge_changes(read_log(spark, path, after), keys, ordering, base)
    return m.where(~F.col("_op").isin("D", DELETE)).drop(*META)


def read_changes_since(spark: SparkSession, path: str, commit: int) -> DataFrame:
    """Change rows written by commits after ``commit`` (U4 / S7), all kinds.

    Columns: the table columns plus ``_op`` and ``_commit``.
    """
    return read_log(spark, path, commit).drop("_seq")
