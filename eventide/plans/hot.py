"""Sliding-window hot lists: hot items (1 h / 5 min) and hot URLs (10 min / 5 s).

Inputs are derived from ``events``: a ``view`` is an item page view whose
item id is ``props.k``; a ``click`` is a GET of page ``event_id % #pages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.topn import render_ranking, top_n
from ..operators.windows import pane_counts, sliding_counts
from ..sources.tables import read_table

ITEM_SIZE, ITEM_SLIDE = "1 hour", "5 minutes"
URL_SIZE, URL_SLIDE = "10 minutes", "5 seconds"
TOP = 5


def item_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == "view")
              .select(F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts"))


def hot_items_counts(spark: SparkSession, sf_dir: str, method: str = "panes") -> DataFrame:
    return sliding_counts(item_views(spark, sf_dir), "item_id", "ts",
                          ITEM_SIZE, ITEM_SLIDE, method=method)


def hot_items_top5(spark: SparkSession, sf_dir: str, method: str = "panes") -> DataFrame:
    return top_n(hot_items_counts(spark, sf_dir, method), "window_end", "n", TOP,
                 ties=["item_id"])


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_ranking(hot_items_top5(spark, sf_dir), "window_end", "item_id", "n")


def url_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events with the id of the page they hit."""
    ev = read_table(spark, sf_dir, "events")
    pages = read_table(spark, sf_dir, "pages")
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    return (ev.where(F.col("event_type") == "click")
              .select((F.col("event_id") % n_pages).alias("page_id"), "ts"))


def with_url(clicks: DataFrame, pages: DataFrame) -> DataFrame:
    """Every click with the URL of its page; one of a page not in the table is kept under the page's id."""
    url = F.coalesce("url", F.concat(F.lit("unlisted page "), F.col("page_id").cast("string")))
    return clicks.join(pages.select("page_id", "url"), "page_id", "left").withColumn("url", url)


def hot_urls_counts(spark: SparkSession, sf_dir: str, method: str = "panes") -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    clicks = url_clicks(spark, sf_dir)
    if method == "window":
        return sliding_counts(with_url(clicks, pages), "url", "ts",
                              URL_SIZE, URL_SLIDE, method="window")
    # Count per (page, 5 s pane) before the lookup: the join then sees one row
    # per page and pane instead of one per click.
    per_pane = pane_counts(clicks, "page_id", "ts", URL_SLIDE)
    return sliding_counts(with_url(per_pane, pages), "url", "pane_start",
                          URL_SIZE, URL_SLIDE, weight="n")


def hot_urls_top5(spark: SparkSession, sf_dir: str, method: str = "panes") -> DataFrame:
    return top_n(hot_urls_counts(spark, sf_dir, method), "window_end", "n", TOP, ties=["url"])
