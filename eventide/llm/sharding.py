"""Sharding by extendible hashing, with DataFrame functions only.

A document's key is a 60-bit hash of its id. The directory starts as one bucket;
a bucket over the byte limit splits on the next bit, and only that bucket. As a
bucket's bytes only fall when it splits, its final depth is the least depth at
which its prefix fits, and that comes from sums per prefix of a fine histogram.
Prefixes that are still too large at the histogram's depth go deeper alone.
The histogram grows with the table, so its joins shuffle beyond the rows of ``join_small``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, written

KEY_BITS = 60
FINER = 6          # the histogram has about 2^FINER cells per full shard
TASK_CELLS = 1 << 15  # cells a task sums over their prefixes
SHARD_BYTES = 64 << 20


def _key() -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bytes): 60 hash bits of the id (of the text where it is null), UTF-8 bytes."""
    return docs.select("doc_id", _key().alias("key"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))


def _join(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """``join_small`` that shuffles beyond its rows; left to Spark, small files are broadcast whatever they unfold to."""
    return join_small(df.hint("merge"), small, on, how)


def _fitting(cells: DataFrame, above: int, bits: int, limit: int) -> DataFrame:
    """(depth, prefix, shard_bytes): prefixes deeper than ``above`` that fit, of parents that do not.

    A prefix meets its sibling in the sum of their parent, so no table is joined.
    """
    spread = cells.repartition(cells.count() // TASK_CELLS + 1, F.shiftright("cell", FINER))
    up = spread.withColumn("depth", F.explode(F.sequence(F.lit(above + 1), F.lit(bits)))).withColumn(
        "prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
    half = lambda bit: F.sum(F.when(F.col("prefix") % 2 == bit, F.col("bytes")))
    pairs = up.groupBy("depth", F.shiftright("prefix", 1).alias("parent")).agg(half(0).alias("left"), half(1).alias("right"))
    pairs = pairs.where(F.coalesce("left", F.lit(0)) + F.coalesce("right", F.lit(0)) > limit)
    both = F.array(*(F.struct((F.col("parent") * 2 + bit).alias("prefix"), F.col(side).alias("shard_bytes"))
                     for bit, side in enumerate(("left", "right"))))
    return pairs.select("depth", F.inline(both)).where(
        F.col("shard_bytes").isNotNull() & ((F.col("shard_bytes") <= limit) | (F.col("depth") == KEY_BITS)))


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """[(bits, cells)]: which shard holds each directory cell.

    ``cells`` (cell, depth, shard, shard_bytes) covers ``bits``-bit prefixes of
    the key; ``shard`` is the shard's prefix as text of ``depth`` bits. A later
    entry covers what is still too large at the bits before it. A single key
    beyond the limit keeps all its bits.
    """
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    if total <= limit:
        zero = F.lit(0).cast("long")
        return [(0, rows.sparkSession.range(1).select(
            zero.alias("cell"), F.lit(0).alias("depth"), F.lit("").alias("shard"), (zero + total).alias("shard_bytes")))]
    above, bits = 0, min(KEY_BITS, math.ceil(math.log2(total / limit)) + FINER)
    found, left = [], rows
    while True:
        cells = written(left.groupBy(F.shiftright("key", KEY_BITS - bits).alias("cell"))
                        .agg(F.sum("bytes").alias("bytes")), "shard-cells")
        fits = written(_fitting(cells, above, bits, limit), "shard-prefixes")
        if depths := sorted(r.depth for r in fits.select("depth").distinct().collect()):
            up = cells.select("cell", F.explode(F.array(*map(F.lit, depths))).alias("depth")).withColumn(
                "prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
            part = _join(up, fits, ["depth", "prefix"]).select(
                "cell", "depth", F.expr("lpad(bin(prefix), depth, '0')").alias("shard"), "shard_bytes")
            found.append((bits, written(part, "shard-directory")))
        open_ = cells.where(F.col("bytes") > limit).select("cell")
        if bits == KEY_BITS or not open_.limit(1).count():
            return found
        left = _join(rows, open_, F.shiftright("key", KEY_BITS - bits) == open_["cell"], "left_semi")
        above, bits = bits, min(KEY_BITS, bits + 8)


def _assigned(docs: DataFrame, limit: int) -> DataFrame:
    rows = written(keyed(docs), "shard-keys")
    out = None
    for bits, cells in directory(rows, limit):
        part = _join(rows.withColumn("cell", F.shiftright("key", KEY_BITS - bits)), cells, "cell")
        out = part if out is None else out.unionByName(part)
    return out


def shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Per row: ``doc_id, bytes, shard, depth, shard_bytes, oversize``.

    A null text has 0 bytes. Rows that share an id share a key and so a shard;
    only such a key alone can pass the limit (``oversize``). Rows without an id
    are keyed by their text. An empty table gives no rows; other columns are not
    read.
    """
    return _assigned(docs, limit).select(
        "doc_id", "bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes",
        (F.col("shard_bytes") > limit).alias("oversize"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write ``docs`` with one folder ``shard=<bits>`` per shard (``shard=root`` for depth 0)."""
    own = _assigned(docs, limit).select(F.col("key").alias("_own"), F.when(
        F.col("shard") == "", "root").otherwise(F.col("shard")).alias("shard")).distinct()
    rows = docs.withColumn("_key", _key()).join(own, F.col("_key") == F.col("_own")).drop("_key", "_own")
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
