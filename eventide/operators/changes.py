"""Change envelopes and precombine.

An envelope is the JSON text ``{"before": {...}, "after": {...}, "op": "c|r|u|d"}``.
Decoding turns it into change rows with a ``kind``:

====== ===========================
op     rows
====== ===========================
c, r   ``+I`` after
u      ``-U`` before, ``+U`` after
d      ``-D`` before
====== ===========================

Malformed text, a NULL payload, an unknown op or a NULL image on the side an
op needs yield no row (the ignore-parse-errors behaviour). Encoding maps
``+I``/``+U`` to op ``c`` with ``after`` and ``-U``/``-D`` to op ``d`` with
``before``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def _schema(row_schema) -> T.StructType:
    return T._parse_datatype_string(row_schema) if isinstance(row_schema, str) else row_schema


def decode_changes(df: DataFrame, value: str, row_schema, keep: list[str] | None = None,
                   kind_col: str = "kind") -> DataFrame:
    """Envelope text -> change rows ``keep..., kind, <row fields>``."""
    rs = _schema(row_schema)
    env = T.StructType([T.StructField("before", rs), T.StructField("after", rs),
                        T.StructField("op", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), env,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    e = df.select(*(keep or []), parsed.alias("_e"))
    ok = F.col("_e").isNotNull() & F.col(f"_e.{CORRUPT}").isNull()

    def change(kind, side):
        return F.struct(F.lit(kind).alias("k"), F.col(f"_e.{side}").alias("r"))

    op = F.col("_e.op")
    rows = (F.when(op.isin("c", "r"), F.array(change(INSERT, "after")))
             .when(op == "u", F.array(change(UPDATE_BEFORE, "before"), change(UPDATE_AFTER, "after")))
             .when(op == "d", F.array(change(DELETE, "before"))))
    # The validity test sits inside the generator, not in a Filter that the
    # optimizer would push below the parse and evaluate with its own
    # from_json; posexplode_outer keeps it from inferring one from the
    # generator (a NULL array yields a NULL `_c`, dropped by the test on it).
    x = (e.select(*(keep or []), F.posexplode_outer(F.when(ok, rows)).alias("_pos", "_c"))
          .where(F.col("_c.r").isNotNull()).drop("_pos"))
    return x.select(*(keep or []), F.col("_c.k").alias(kind_col),
                    *[F.col(f"_c.r.{f.name}").alias(f.name) for f in rs.fields])


def encode_changes(df: DataFrame, row_cols: list[str], kind_col: str = "kind",
                   keep: list[str] | None = None, out: str = "value") -> DataFrame:
    """Change rows -> envelope text."""
    row = F.struct(*[F.col(c) for c in row_cols])
    k = F.col(kind_col)
    after_side = k.isin(INSERT, UPDATE_AFTER)
    before_side = k.isin(UPDATE_BEFORE, DELETE)
    env = F.struct(F.when(before_side, row).alias("before"),
                   F.when(after_side, row).alias("after"),
                   F.when(after_side, F.lit("c")).when(before_side, F.lit("d")).alias("op"))
    return (df.where(after_side | before_side)
              .select(*(keep or []), F.to_json(env).alias(out)))


def precombine(df: DataFrame, keys, ordering, seq: str | None = None) -> DataFrame:
    """Keep, per key, the row with the greatest ``ordering``.

    ``ordering`` is one column or a list compared left to right; equal
    ordering values go to the greater ``seq`` (later arrival). Written as a
    ``max_by`` aggregation, so it combines map-side and a hot key sends one row
    per task over the shuffle. (Spark plans it as a sort aggregation: every task
    sorts its own rows by key before and after the shuffle.)
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ordering = [ordering] if isinstance(ordering, str) else list(ordering)
    rank = F.struct(*[F.col(c) for c in ordering + ([seq] if seq else [])])
    rest = [c for c in df.columns if c not in keys]
    w = (df.groupBy(*keys)
           .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_w")))
    return w.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*df.columns)
