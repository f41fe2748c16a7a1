"""Time-bucket arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_of(dtype: T.DataType) -> Column:
    """1970-01-01 00:00 as a literal of the same timestamp flavour as ``dtype``."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_seconds(F.lit(0))


NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_to_instant(c: Column) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` at the same wall clock read as UTC.

    Unlike ``CAST(c AS TIMESTAMP)`` this does not depend on the session time
    zone (no shift in a DST gap). Watermarks need ``timestamp``.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(NTZ_EPOCH), c))


def instant_to_ntz(c: Column) -> Column:
    """Inverse of :func:`ntz_to_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(NTZ_EPOCH))
