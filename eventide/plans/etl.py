"""JSON ETL: messages with a data array, exploded and enriched with an area.

Messages are built from the order tables in the reference's message shape::

    {"dt": "<o_orderdate>", "countryCode": "<customer nation>",
     "data": [{"type": l_returnflag, "score": l_discount, "level": l_linestatus,
               "line": l_linenumber}, ...]}

The typed form reads the declared element fields (``line`` is ignored); the
open form forwards every element key.

The area dimension is the reference's ``area -> "c1,c2,..."`` hash, built
from ``region``/``nation``. It publishes every region except MIDDLE EAST, so
messages from those nations show the unknown-country path (row kept, no area).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import parse_json, to_json_text
from ..operators.enrich import explode_enrich, explode_enrich_open, invert_groups
from ..sources.tables import read_table

MESSAGE_SCHEMA = ("dt string, countryCode string, "
                  "data array<struct<type: string, score: double, level: string>>")
WIDE_AREA = "WORLD"      # lists some countries that a region lists too


def area_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(area, countries)``: one row per region with its nations as CSV, and a wide area.

    Grouped over the ``nation`` table, a bounded dimension. Every fifth nation
    stands in two areas.
    """
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    own = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("r_name").alias("area"), "n_name")
    wide = nation.where(F.col("n_nationkey") % 5 == 0).select(F.lit(WIDE_AREA).alias("area"), "n_name")
    return (own.union(wide).groupBy("area")
                  .agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("countries")))


def dimension_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country -> area."""
    return invert_groups(area_hash(spark, sf_dir), "area", "countries", member="country")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: one JSON message per order (orders without lines carry ``[]``).

    Orders are joined to their lines on the order key and then grouped by
    it, so the group reuses the join's partitioning (no third shuffle) and a
    message gathers only its own order's lines. Every tenth customer's code is
    unknown to the dimension.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_discount", "l_linestatus", "l_linenumber")
    o = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
               .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
               .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    element = F.struct(F.col("l_returnflag").alias("type"), F.col("l_discount").alias("score"),
                       F.col("l_linestatus").alias("level"), F.col("l_linenumber").alias("line"))
    o = o.withColumn("code", F.when(F.col("o_custkey") % 10 == 0, F.concat(F.lit("?"), "n_name")).otherwise(F.col("n_name")))
    per_order = (o.groupBy("o_orderkey", "o_orderdate", "code")
                  .agg(F.collect_list(F.when(F.col("l_orderkey").isNotNull(), element)).alias("data")))
    return per_order.select(to_json_text(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dt"),
        F.col("code").alias("countryCode"), F.col("data")).alias("value"))


def etl_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, exploded and enriched elements: type, score, level, dt, area."""
    msgs = parse_json(messages(spark, sf_dir), "value", MESSAGE_SCHEMA,
                      on_error="fail", required=["data"]).select("msg.*")
    return explode_enrich(msgs, "data", carry=["dt"], dim=dimension_inverted(spark, sf_dir),
                          key="countryCode", dim_key="country", dim_value="area")


def etl_enriched_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched elements as the JSON text the ETL job writes (P5)."""
    e = etl_enriched(spark, sf_dir)
    return e.select(to_json_text(*[F.col(c) for c in e.columns]).alias("value"))


def etl_enriched_open_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-key ETL: every element key is forwarded, ``dt`` and ``area`` added."""
    return explode_enrich_open(messages(spark, sf_dir), "value", "$.data", {"dt": "$.dt"},
                               dim=dimension_inverted(spark, sf_dir), key_path="$.countryCode",
                               dim_key="country", dim_value="area")
