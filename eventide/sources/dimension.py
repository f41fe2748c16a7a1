"""Dimension snapshots (S4): ``group -> "m1,m2,..."`` rows inverted to a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import invert_groups


def read_dimension(spark: SparkSession, path: str, group: str = "area",
                   members: str = "countries", member: str = "country",
                   fmt: str = "parquet") -> DataFrame:
    """Read a group/members dimension and invert it to ``member -> group``.

    Re-read it for every micro-batch (see
    :class:`eventide.streaming.enrich.DimensionSnapshot`), which publishes
    what each micro-batch used and keeps the last non-empty snapshot over restarts.
    """
    raw = spark.read.format(fmt).load(path)
    return invert_groups(raw, group, members, member=member)
