"""JSON parsing and serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, value: str, schema, on_error: str = "fail",
               required: list[str] | None = None, keep: list[str] | None = None,
               out: str = "msg", error_col: str = "_bad_json") -> DataFrame:
    """Parse a JSON text column with a declared schema.

    Missing fields become NULL (not an error). A row is bad when the text is
    not a JSON object, or when a field named in ``required`` is NULL.
    ``on_error`` is ``"fail"``, ``"drop"`` (the tolerant table source S2) or
    ``"quarantine"`` (raw text kept in ``error_col``).
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keep_cols = [F.col(k) for k in (keep or [])]
    # Parse once in its own projection; the checks and the output read the
    # parsed struct. (A Filter here would be pushed below it and re-parse.)
    tmp = df.select(*keep_cols, F.col(value).alias("_raw"), parsed.alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    for r in required or []:
        bad = bad | F.col(f"_p.{r}").isNull()
    body = F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])
    if on_error == "fail":
        boom = F.raise_error(F.concat(F.lit("malformed JSON: "),
                                      F.coalesce(F.col("_raw"), F.lit("NULL"))))
        # In a generator the check cannot be pruned with the column, so even count() fails.
        return tmp.select(*keep_cols, F.inline(F.when(bad, boom).otherwise(F.array(F.struct(body.alias(out))))))
    if on_error == "drop":
        t2 = tmp.select(*keep_cols, F.struct(body.alias(out)).alias("_row"), bad.alias("_bad"))
        return t2.select(*keep_cols, F.inline(F.when(~F.col("_bad"), F.array(F.col("_row")))))
    if on_error == "quarantine":
        return tmp.select(*keep_cols, body.alias(out), F.when(bad, F.col("_raw")).alias(error_col))
    raise ValueError(f"on_error must be fail, drop or quarantine, not {on_error!r}")


def to_json_text(*cols) -> Column:
    """Serialise columns as one JSON object; NULL fields are left out (P5)."""
    return F.to_json(F.struct(*cols))
