"""Name -> query callable ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog, cdc, etl, hot, parsing, patterns, streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "hot_items_counts": hot.hot_items_counts,
    "hot_items_top5": hot.hot_items_top5,
    "hot_items_report": hot.hot_items_report,
    "hot_urls_counts": hot.hot_urls_counts,
    "hot_urls_top5": hot.hot_urls_top5,
    "parse_behavior": parsing.parse_behavior,
    "parse_access_log": parsing.parse_access_log,
    "behavior_text_roundtrip": parsing.behavior_text_roundtrip,
    "dimension_inverted": etl.dimension_inverted,
    "etl_enriched": etl.etl_enriched,
    "etl_enriched_json": etl.etl_enriched_json,
    "etl_enriched_open_json": etl.etl_enriched_open_json,
    "adjacent_change": patterns.adjacent_change_q,
    "order_status": patterns.order_status,
    "order_status_10s": patterns.order_status_10s,
    "order_status_as_of": patterns.order_status_as_of,
    "order_paid": patterns.order_paid,
    "order_timeout": patterns.order_timeout,
    "login_changes_from_text": patterns.login_changes_from_text,
    "order_status_from_text": patterns.order_status_from_text,
    "order_derived": cdc.order_derived,
    "order_table_sql": catalog.order_table_sql,
    "order_day_sql": catalog.order_day_sql,
    "order_table_snapshot": cdc.order_table_snapshot,
    "order_user_snapshot": cdc.order_user_snapshot,
    "changes_decoded": cdc.changes_decoded,
    "changes_encoded": cdc.changes_encoded,
    "latest_state": cdc.latest_state,
    "cdc_table_snapshot": cdc.cdc_table_snapshot,
    "cdc_changes_since": cdc.cdc_changes_since,
    "upsert_snapshot": cdc.upsert_snapshot,
    "changes_since": cdc.changes_since,
    "compacted_snapshot": cdc.compacted_snapshot,
    "limit20": cdc.limit20,
    "stream_hot_items_top5": streams.stream_hot_items_top5,
    "stream_hot_urls_top5": streams.stream_hot_urls_top5,
    "stream_order_status": streams.stream_order_status,
    "stream_order_timeout": streams.stream_order_timeout,
    "stream_adjacent_change": streams.stream_adjacent_change_q,
    "stream_login_changes_from_text": streams.stream_login_changes_from_text,
    "stream_order_table": streams.stream_order_table,
    "stream_etl_enriched": streams.stream_etl_enriched,
    "stream_etl_lines": streams.stream_etl_lines,
    "stream_change_capture": streams.stream_change_capture,
    "stream_upsert_snapshot": streams.stream_upsert_snapshot,
    "stream_changes_since": streams.stream_changes_since,
}
