"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets an expected number of copies, its source's target divided
by the source's size. The whole part is certain; the rest is a probability. The
rounding works on *word mass* (probability times size): two documents move mass
from one to the other, at random but without changing expectations, until one
holds none or a whole copy. So a source's words stay exactly on target until
the last open document, and no document gains more than one copy.

The pairs form a reduction tree: in a bucket of about ``FAN`` documents, largest
first, the open document meets the next one until one of them is settled, so a
large one is worked off by many small ones and the one left open tends to be
small. The open ones of the buckets meet in buckets of the next level. Every pair
draws for itself: no document's fate is tied to a group, and where one document
outweighs all others it stays open to the end and is drawn by its own odds (the
source then misses its target by less than that document).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import join_small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
FAN = 4096


def _uid() -> Column:
    no_id = F.when(F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))
    return F.xxhash64(F.col("doc_id").cast("string"), no_id)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, uid, size): words of every row; ``uid`` names the document.

    Rows that repeat an id in a source are one document, and so are rows without
    an id that repeat a text.
    """
    return docs.select(
        "doc_id", "source", _uid().alias("uid"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n, target) from ``sized`` rows; one row per source.

    Sources in code-point order, null last, take the weights in turn and share
    the total size; no target passes ``cap`` times the source's size, the excess
    is reshared by weight. Sources that reach their cap are a prefix in the
    order of cap / weight, so the shares come from running sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("turn", turn).withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    fill = Window.orderBy((F.col("source_size") / F.col("w")).asc(), "turn")
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = (per.withColumn("limit", cap * F.col("source_size").cast("double"))
           .withColumn("total", F.sum("source_size").over(every).cast("double"))
           .withColumn("left", F.col("total") - (F.sum("limit").over(upto) - F.col("limit")))
           .withColumn("w_left", F.sum("w").over(every) - (F.sum("w").over(upto) - F.col("w")))
           .withColumn("full", F.col("left") * F.col("w") > F.col("limit") * F.col("w_left"))
           .withColumn("share", (F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(every), F.lit(0.0)))
                       / F.sum(F.when(~F.col("full"), F.col("w"))).over(every)))
    return per.select("source", "source_size", "n",
                      F.when(F.col("full"), F.col("limit")).otherwise(F.col("share") * F.col("w")).alias("target"))


def pivot(mass: np.ndarray, size: np.ndarray, rng: np.random.Generator, last: bool = False) -> np.ndarray:
    """Move mass between neighbours until all but at most one hold 0 or their size.

    ``last`` settles the open one too, keeping its expectation.
    """
    mass, draws, open_ = mass.copy(), rng.random(len(mass) + 1), -1
    for j in range(len(mass)):
        if not 0 < mass[j] < size[j]:
            continue
        if open_ < 0:
            open_ = j
            continue
        up = min(size[open_] - mass[open_], mass[j])          # j gives to the open one
        down = min(mass[open_], size[j] - mass[j])            # the open one gives to j
        if draws[j] * (up + down) < down:
            full, empty = up == size[open_] - mass[open_], up == mass[j]
            mass[open_] = size[open_] if full else mass[open_] + up
            mass[j] = 0.0 if empty else mass[j] - up
        else:
            empty, full = down == mass[open_], down == size[j] - mass[j]
            mass[open_] = 0.0 if empty else mass[open_] - down
            mass[j] = size[j] if full else mass[j] + down
        if not 0 < mass[open_] < size[open_]:
            open_ = j if 0 < mass[j] < size[j] else -1
    if last and open_ >= 0:
        mass[open_] = size[open_] if draws[-1] * size[open_] < mass[open_] else 0.0
    return mass


def _level(rows: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    def settle(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import xxhash

        rng = np.random.default_rng(xxhash.xxh64_intdigest(repr((seed, level, key[0], int(key[1])))))
        group = group.sort_values(["size", "uid"], ascending=[False, True], kind="stable")
        size, mass = group["size"].to_numpy(float), group["mass"].to_numpy(float)
        group["mass"] = pivot(mass, size, rng, last)
        return group

    return rows.groupBy("source", "bucket").applyInPandas(settle, rows.schema)


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """Per row: ``doc_id, source, uid, size, source_size, target, copies, taken``.

    ``size`` counts runs without ASCII white space (null text: 0), ``taken`` is
    ``copies * size``, at most ``cap`` times the size. The draw depends on the
    seed, ids, sources and sizes alone, so reruns agree. An empty text is taken
    with its whole copies only; a table without words takes nothing; an empty
    table gives no rows. Null is a source of its own.
    """
    ship_package(docs.sparkSession)
    sizes = written(sized(docs), "mix-sizes")
    targets = written(source_targets(sizes, weights, cap), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    rate = targets.select(F.col("source").alias("s"), "source_size", "target", "n", ratio.alias("ratio"))
    rows = join_small(sizes, rate, sizes["source"].eqNullSafe(rate["s"]))
    part = F.col("ratio") - F.floor("ratio")
    units = (rows.groupBy("source", "uid").agg(F.sum("size").cast("double").alias("size"), F.max("n").alias("n"),
                                               F.max(part).alias("part"))
             .where("part > 0 AND size > 0")
             .select("source", "uid", "size", (F.col("part") * F.col("size")).alias("mass"),
                     F.pmod("uid", F.ceil(F.col("n") / FAN)).alias("bucket")))
    most = targets.agg(F.max("n")).first()[0] or 0
    settled, buckets, level = [], math.ceil(most / FAN), 0
    while True:
        last = buckets <= 1
        done = written(_level(units, level, seed, last), f"mix-level{level}")
        settled.append(done.where("mass <= 0 OR mass >= size"))
        if last:
            break
        units = done.where("mass > 0 AND mass < size").withColumn("bucket", F.floor(F.col("bucket") / FAN))
        buckets, level = math.ceil(buckets / FAN), level + 1
    extra = settled[0]
    for s in settled[1:]:
        extra = extra.union(s)
    extra = extra.where("mass > 0").select(F.col("source").alias("es"), F.col("uid").alias("eu"))
    out = rows.join(extra, rows["source"].eqNullSafe(F.col("es")) & (rows["uid"] == F.col("eu")), "left")
    n = (F.floor("ratio") + F.when(F.col("eu").isNotNull(), 1).otherwise(0)).cast("long")
    return (out.withColumn("copies", n)
            .select("doc_id", "source", "uid", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as many times as it is taken, all columns kept."""
    n = copies(docs, weights, cap, seed).where("copies > 0").select(
        F.col("source").alias("_source"), F.col("uid").alias("_uid"), F.col("copies").alias("_copies")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("source").alias("_s"), _uid().alias("_u"))
    joined = row.join(n, F.col("_s").eqNullSafe(F.col("_source")) & (F.col("_u") == F.col("_uid")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
