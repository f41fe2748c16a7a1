"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups.

DataFrame functions only. One pass moves texts: ``(hash, normalised text)`` is
the grouping key, so partial aggregation reduces a large group of copies to one
row per map task before the shuffle, and equal hashes with different bytes land
in different classes. Everything else works on (id, hash) rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written


def content_hash(norm: Column) -> Column:
    """128-bit MD5 of the normalised text, as 16 bytes."""
    return F.unhex(F.md5(norm))


def text_classes(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(h, norm, n, keep): one row per distinct normalised text."""
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    return (docs.select("doc_id", norm.alias("norm"))
            .groupBy(digest(F.col("norm")).alias("h"), "norm")
            .agg(F.count("*").alias("n"), F.max("doc_id").alias("keep")))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty
    text. ``keep_id`` is the largest ``doc_id`` of the equal texts (null ids are
    ignored; null only if the group has no id) and ``kept`` says that the row
    carries it, null matching null, so rows that repeat an id and a text are all
    marked kept. An empty table gives no rows; other columns are not read.
    """
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    slim = docs.select("doc_id", norm.alias("norm")).select(
        "doc_id", digest(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("text_sha256"))
    classes = text_classes(docs, digest).select(
        F.col("h").alias("g"), F.sha2("norm", 256).alias("g_sha"), "n", "keep")
    per_hash = written(classes.groupBy("g").agg(
        F.count("*").alias("classes"), F.max("n").alias("n"), F.max("keep").alias("keep")), "dedup-classes")
    single = slim.join(per_hash.where("classes = 1"), F.col("h") == F.col("g"))
    out = _columns(single)
    if per_hash.where("classes > 1").limit(1).count():
        clash = per_hash.where("classes > 1").select("g")
        # Different bytes under one hash: only there the text itself is the key.
        full = docs.select("doc_id", norm.alias("norm")).withColumn("h", digest(F.col("norm")))
        apart = text_classes(docs, digest).select(F.col("h").alias("g"), F.col("norm").alias("g_norm"), "n", "keep")
        rows = full.join(apart.join(clash, "g", "left_semi"),
                         (F.col("h") == F.col("g")) & (F.col("norm") == F.col("g_norm")))
        out = out.unionByName(_columns(rows.withColumn("text_sha256", F.sha2("norm", 256))))
    return out


def _columns(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
                       F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The kept row of every group of equal texts, with all columns of ``docs``.

    Of equal texts the row with the largest ``doc_id`` stays (a null id loses to
    any id); of rows that repeat that id, the one with the greatest ``(text,
    source, lang)``. One shuffle, combined map-side, without a join back.
    """
    order = [c for c in ("doc_id", "text", "source", "lang") if c in docs.columns]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    return (docs.select(norm.alias("_norm"), row.alias("_row"), F.struct(*order).alias("_order"))
            .groupBy(digest(F.col("_norm")).alias("_h"), "_norm")
            .agg(F.max_by("_row", "_order").alias("_row")).select("_row.*"))
