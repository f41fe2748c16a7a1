"""Parsing of delimited lines and time values.

All expressions are built-in Spark functions, so they stay inside whole-stage
codegen, and none of them depends on the session time zone: timestamps are
produced as ``timestamp_ntz`` by adding to the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# A whole number as a Java Long parser accepts it: optional sign, digits, no
# blanks.
STRICT_LONG = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quote(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def split_fields(value, sep: str = ",") -> Column:
    """Split like Java's ``String.split``: no quoting, trailing empties dropped.

    As in Java, an empty line is one empty field and a line made only of
    separators has no fields at all.
    """
    q = _quote(sep)
    v = _col(value)
    stripped = F.regexp_replace(v, f"({q})+$", "")
    return F.when((stripped == "") & (v != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, q))


def strict_long(text) -> Column:
    t = _col(text)
    return F.when(t.rlike(STRICT_LONG), t.try_cast("bigint"))


def typed_field(text: Column, dtype) -> Column:
    """Convert one text field; NULL when it does not parse."""
    if isinstance(dtype, str):
        dtype = T._parse_datatype_string(dtype)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return strict_long(text).try_cast(dtype)
    if isinstance(dtype, T.StringType):
        return text
    return text.try_cast(dtype)


def parse_delimited(df: DataFrame, value: str, schema, sep: str = ",",
                    on_error: str = "fail", keep: list[str] | None = None,
                    error_col: str = "_bad_line") -> DataFrame:
    """Turn delimited text lines into typed columns.

    ``schema`` is a ``StructType`` or a DDL string listing the fields in line
    order; extra fields on a line are ignored. A line is bad when a field is
    missing or does not convert (a long must match ``[+-]?digits``; no
    trimming). ``on_error``:

    * ``"fail"``: the job stops with the bad line in the message (the
      reference job dies on such a line);
    * ``"drop"``: bad lines are removed;
    * ``"quarantine"``: every line is kept and ``error_col`` holds the raw
      text of bad lines (NULL otherwise), so a caller can split the result.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    parts = split_fields(value, sep)
    fields, bad = [], F.lit(False)
    for i, f in enumerate(schema.fields):
        raw = F.get(parts, i)
        conv = typed_field(raw, f.dataType)
        fields.append((f.name, conv))
        bad = bad | raw.isNull() | conv.isNull()
    keep_cols = [F.col(k) for k in (keep or [])]
    # Everything is computed in projections, where Spark evaluates the shared
    # split once per row. (A Filter on `bad` would be pushed below the
    # projection and re-split the line for every field it references.)
    if on_error == "fail":
        rows = df.select(*keep_cols, F.col(value).alias("_line"),
                         F.struct(*[c.alias(n) for n, c in fields]).alias("_row"), bad.alias("_bad"))
        boom = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce("_line", F.lit("NULL"))))
        # In a generator the check cannot be pruned with the columns, so even count() fails;
        # it reads the row and the flag of the projection below, never the line's fields.
        return rows.select(*keep_cols, F.inline(F.when(F.col("_bad"), boom).otherwise(F.array("_row"))))
    if on_error == "drop":
        return drop_bad(df.select(*keep_cols, F.struct(*[c.alias(n) for n, c in fields]).alias("_row"),
                                  bad.alias("_bad")), keep or [])
    if on_error == "quarantine":
        return df.select(*keep_cols, *[c.alias(n) for n, c in fields],
                         F.when(bad, F.col(value)).alias(error_col))
    raise ValueError(f"on_error must be fail, drop or quarantine, not {on_error!r}")


def drop_bad(df: DataFrame, keep: list[str], row: str = "_row", bad: str = "_bad") -> DataFrame:
    """``keep`` columns plus the fields of struct ``row``, for rows where ``bad`` is false.

    Written as ``inline(CASE WHEN NOT bad THEN array(row) END)`` rather than a
    filter, so the optimizer cannot push the test below the projection that
    computes ``row`` and ``bad`` once per input row.
    """
    return df.select(*[F.col(k) for k in keep],
                     F.inline(F.when(~F.col(bad), F.array(F.col(row)))))


def _epoch() -> Column:
    return F.expr(EPOCH_NTZ)


def epoch_seconds_to_ts(c) -> Column:
    """Epoch seconds -> ``timestamp_ntz``."""
    return F.timestamp_add("SECOND", _col(c), _epoch())


def epoch_millis_to_ts(c) -> Column:
    """Epoch milliseconds -> ``timestamp_ntz``."""
    return F.timestamp_add("MILLISECOND", _col(c), _epoch())


def ts_to_epoch_seconds(c) -> Column:
    """``timestamp_ntz`` -> whole epoch seconds (fraction dropped)."""
    return F.timestamp_diff("SECOND", _epoch(), _col(c))


def ts_to_epoch_millis(c) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), _col(c))


def truncate_to_millis(ts) -> Column:
    """Drop sub-millisecond digits of a ``timestamp_ntz`` (truncates, .1249 -> .124)."""
    t = _col(ts)
    micros = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint") % 1000
    return F.timestamp_add("MICROSECOND", -micros, t)


def to_timestamp3(text) -> Column:
    """SQL ``CAST(text AS TIMESTAMP(3))`` (P10): NULL when unparseable."""
    return truncate_to_millis(_col(text).try_cast("timestamp_ntz"))


def parse_datetime(text, fmt: str = "yyyy-MM-dd HH:mm:ss", epoch0: bool = False) -> Column:
    """Pattern parse to ``timestamp_ntz``.

    Unparseable text gives NULL; with ``epoch0=True`` it gives 1970-01-01
    instead, which is what the reference job does.
    """
    parsed = F.try_to_timestamp(_col(text), F.lit(fmt)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.expr(EPOCH_NTZ)) if epoch0 else parsed


def substr0(text, n: int) -> Column:
    """First ``n`` characters (SQL ``substring(text, 0, n)`` in the jobs, P9)."""
    return F.substring(_col(text), 1, n)
