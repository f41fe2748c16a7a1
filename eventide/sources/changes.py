"""Database change capture, re-aimed.

There is no binlog reader here. A database table enters as an initial
snapshot read over JDBC, whose rows are inserts; later changes arrive as
change envelopes on a topic or in files and are decoded with
:func:`eventide.operators.changes.decode_changes`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import INSERT, decode_changes
from .lines import read_lines
from .positions import read_positioned_lines


def snapshot_as_changes(df: DataFrame, kind_col: str = "kind") -> DataFrame:
    """Rows of an initial snapshot as ``+I`` change rows."""
    return df.select(F.lit(INSERT).alias(kind_col), *df.columns)


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                       partition_column: str | None = None, lower: int | None = None,
                       upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """Initial table snapshot over JDBC as ``+I`` rows (parallel when a numeric
    ``partition_column`` with bounds is given)."""
    if partition_column:
        df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                             upperBound=upper, numPartitions=partitions, properties=properties or {})
    else:
        df = spark.read.jdbc(url, table, properties=properties or {})
    return snapshot_as_changes(df)


def read_change_envelopes(spark: SparkSession, row_schema, path: str | None = None,
                          topic: str | None = None, bootstrap: str | None = None,
                          stream: bool = False, positions: bool = False, log: str | None = None) -> DataFrame:
    """Change envelopes (files or topic) decoded to change rows, bad ones skipped.

    With ``positions`` files are read by :func:`read_positioned_lines` and ``seq`` is a bigint.
    """
    if positions:
        lines = read_positioned_lines(spark, path, stream=stream, log=log)
    else:
        lines = read_lines(spark, path=path, topic=topic, bootstrap=bootstrap, stream=stream)
    return decode_changes(lines, "value", row_schema, keep=["seq"])
