"""Tolerant JSON table source (S2): missing fields NULL, unparseable rows skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.json import parse_json
from .lines import read_lines
from .positions import read_positioned_lines


def read_json_table(spark: SparkSession, schema, path: str | None = None, topic: str | None = None,
                    bootstrap: str | None = None, stream: bool = False,
                    starting: str = "earliest", positions: bool = False, log: str | None = None) -> DataFrame:
    """JSON lines as a typed table: columns of ``schema`` and the arrival ``seq``.

    With ``positions`` files are read by :func:`read_positioned_lines`, whose bigint
    ``seq`` the upsert table and the patterns take.
    """
    if positions:
        lines = read_positioned_lines(spark, path, stream=stream, log=log)
    else:
        lines = read_lines(spark, path=path, topic=topic, bootstrap=bootstrap, stream=stream,
                           starting=starting)
    return parse_json(lines, "value", schema, on_error="drop", keep=["seq"]).select("msg.*", "seq")
