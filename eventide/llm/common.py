"""Helpers shared by the operators: shared-folder tables, bounded broadcasts, texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

BROADCAST_ROWS = 50_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's shared checkpoint folder and read back.

    Cuts the lineage so that a lost executor costs a re-read and not a re-run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back; Spark drops the shuffle files that led to it.

    Nothing else may read the exchanges of ``df``. The caller removes the folder when
    no later step reads it.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def join_small(df: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a written table of fixed-width rows: broadcast up to ``max_rows`` of them.

    Beyond that the join shuffles and adaptive execution splits skewed keys.
    ``small`` must come from ``written`` (it is counted first).
    """
    if small.count() <= max_rows:
        small = F.broadcast(small)
    return df.join(small, on, how)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character kept."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))


def texts(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns and ``text`` (null as empty), ready for tasks in Python."""
    ship_package(docs.sparkSession)
    return docs.select(*[F.col(c) for c in cols], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def documents(spark: SparkSession, sf_dir: str, cols: Sequence[str] = ()) -> DataFrame:
    """The ``documents`` table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*cols) if cols else df
