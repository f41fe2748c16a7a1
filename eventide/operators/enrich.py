"""Dimension inversion and explode-plus-lookup enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import split_fields

def invert_groups(df: DataFrame, group: str, members: str, sep: str = ",",
                  member: str = "member") -> DataFrame:
    """``(group, "m1,m2,...")`` -> one row ``(member, group)`` per member.

    Members are split like Java ``String.split`` (no trimming, trailing empty
    entries dropped). A member listed under several groups keeps the greatest
    group name, so the result has unique members and a lookup against it never
    multiplies rows. Aggregation is partial, map-side.
    """
    return (df.select(F.col(group).alias("_g"),
                      F.explode(split_fields(members, sep)).alias(member))
              .groupBy(member).agg(F.max("_g").alias(group)))


def explode_rows(df: DataFrame, array_col: str, out: str) -> DataFrame:
    """``explode``: one row per element (NULL elements included), none for an
    empty or NULL array.

    Written as ``posexplode_outer`` plus a test on the position: a plain
    ``explode`` lets the optimizer infer ``size(array) > 0`` and push it below
    the projection that builds the array (for instance a ``from_json``),
    which then runs twice per row. A predicate on generator output stays put.
    """
    rest = [c for c in df.columns if c != array_col]
    return (df.select(*rest, F.posexplode_outer(array_col).alias("_pos", out))
              .where(F.col("_pos").isNotNull()).drop("_pos"))


def explode_enrich(msgs: DataFrame, array_col: str, carry: list[str],
                   dim: DataFrame | None = None, key: str | None = None,
                   dim_key: str | None = None, dim_value: str | None = None,
                   element_fields: list[str] | None = None) -> DataFrame:
    """One row per element of ``array_col`` with message-level fields added.

    * an empty or NULL array gives no rows;
    * every ``carry`` field (e.g. ``dt``) is copied onto each element and
      replaces an element field of the same name;
    * with ``dim``, ``dim_value`` is looked up by ``msgs[key] = dim[dim_key]``
      (left outer: unknown keys give NULL, the row is kept). The dimension must
      have unique keys (see :func:`invert_groups`). Spark picks the join from
      sizes in bytes; there is no hint.

    Output columns: the element fields (minus replaced ones), ``carry``, then
    ``dim_value``. The message stream is never shuffled when the dimension is
    broadcast.
    """
    exploded = explode_rows(msgs.select(*[F.col(c) for c in carry],
                                        *([F.col(key).alias("_key")] if dim is not None else []),
                                        F.col(array_col).alias("_arr")), "_arr", "_el")
    if element_fields is None:
        element_fields = [f.name for f in exploded.schema["_el"].dataType.fields]
    own = [f for f in element_fields if f not in carry and f != dim_value]
    cols = [F.col(f"_el.{f}").alias(f) for f in own] + [F.col(c) for c in carry]
    if dim is None:
        return exploded.select(*cols)
    d = dim.select(F.col(dim_key).alias("_key"), F.col(dim_value).alias("_val"))
    joined = exploded.join(d, "_key", "left")
    return joined.select(*cols, F.col("_val").alias(dim_value))


def explode_enrich_open(msgs: DataFrame, value: str, array_path: str, carry: dict[str, str],
                        dim: DataFrame | None = None, key_path: str | None = None,
                        dim_key: str | None = None, dim_value: str | None = None,
                        on_error: str = "drop", out: str = "value") -> DataFrame:
    """Open-key form of :func:`explode_enrich` over JSON text.

    Elements keep whatever keys they have: each element is read as a VARIANT
    object (``map<string, variant>``), the ``carry`` fields (name -> JSON
    path in the message) and the looked-up ``dim_value`` replace keys of the
    same name, and the element is written back as JSON text in ``out``.
    NULL values are not added, so an unknown key has no ``dim_value`` key, as
    in the reference output. Messages that are not JSON or lack the array,
    and array elements that are not objects, are dropped (``on_error="drop"``)
    or fail the job (``"fail"``).
    """
    v = F.try_parse_json(F.col(value))
    arr = F.try_variant_get(v, array_path, "array<variant>")
    bad = arr.isNull()
    if on_error == "fail":
        arr = F.when(bad, F.raise_error(F.concat(F.lit("malformed message: "),
                                                 F.coalesce(F.col(value), F.lit("NULL"))))).otherwise(arr)
    elif on_error != "drop":
        raise ValueError("on_error must be drop or fail")
    carried = [F.try_variant_get(v, path, "string").alias(name) for name, path in carry.items()]
    keyed = [F.try_variant_get(v, key_path, "string").alias("_key")] if dim is not None else []
    exploded = explode_rows(msgs.select(*carried, *keyed, arr.alias("_arr")), "_arr", "_el")
    if dim is not None:
        d = dim.select(F.col(dim_key).alias("_key"), F.col(dim_value).alias("_val"))
        exploded = exploded.join(d, "_key", "left")
    replaced = list(carry) + ([dim_value] if dim is not None else [])
    as_map = F.col("_el").try_cast("map<string,variant>")
    if on_error == "fail":
        as_map = F.when(as_map.isNull(), F.raise_error(F.lit("array element is not a JSON object"))).otherwise(as_map)
    else:
        # A predicate on generator output: it stays above the explode.
        exploded = exploded.where(F.col("_el").try_cast("map<string,variant>").isNotNull())
    base = F.map_filter(as_map, lambda k, _: ~k.isin(*replaced))
    added = [(name, F.col(name)) for name in carry] + ([(dim_value, F.col("_val"))] if dim is not None else [])
    empty = F.create_map().cast("map<string,variant>")
    parts = [base] + [F.when(c.isNotNull(), F.create_map(F.lit(n), c.cast("variant"))).otherwise(empty)
                      for n, c in added]
    return exploded.select(F.to_json(F.map_concat(*parts)).alias(out))
