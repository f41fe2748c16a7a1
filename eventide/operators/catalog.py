"""Catalog tables partitioned by day: created, filled and read by SQL statements.

The statements are Spark SQL; this module only words them, so that a job can be
written as a list of statements over registered views and its result can be queried
by name, with the partitions that a filter leaves out never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_table(spark: SparkSession, name: str, columns: str, location: str, partition: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` of Parquet files at ``location``; ``partition`` is one of the ``columns`` (DDL)."""
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet{by} LOCATION '{location}'")
    if partition and path_exists(spark, location):
        spark.sql(f"ALTER TABLE {_quoted(name)} RECOVER PARTITIONS")     # folders that are there already


def insert_select(spark: SparkSession, name: str, columns: list[str], query: str, partition: str | None = None,
                  overwrite: bool = False) -> None:
    """``INSERT INTO name SELECT columns FROM (query)``, by name.

    With ``partition`` the rows are rebalanced by it first: a few files a partition,
    and a large partition is split over several tasks. ``overwrite`` replaces the
    whole table.
    """
    hint = f"/*+ REBALANCE(`{partition}`) */ " if partition else ""
    listed = ", ".join(f"`{c}`" for c in columns)
    verb = "OVERWRITE" if overwrite else "INTO"
    spark.sql(f"INSERT {verb} {_quoted(name)} ({listed}) SELECT {hint}{listed} FROM ({query}) AS q")


def insert_values(spark: SparkSession, name: str, columns: list[str], rows: list[tuple]) -> None:
    """``INSERT INTO name VALUES ...`` with the values as parameters; no rows, no statement."""
    if not rows:
        return
    kinds = spark.table(_quoted(name)).schema
    marks = ", ".join("(" + ", ".join(f"CAST(:r{i}_{j} AS {kinds[c].dataType.simpleString()})" for j, c in enumerate(columns)) + ")"
                      for i in range(len(rows)))
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT INTO {_quoted(name)} ({listed}) VALUES {marks}", args={f"r{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r)})


def refresh_table(spark: SparkSession, name: str) -> DataFrame:
    """The table with the partitions that other writers have added since."""
    spark.sql(f"ALTER TABLE {_quoted(name)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(_quoted(name))
    return spark.table(_quoted(name))
