"""Independent DuckDB SQL for every registered query (same column names).

Tables are DuckDB views over the same Parquet files. These statements are
written from the operator semantics, not from the Spark plans: sliding windows
as time buckets crossed with window offsets, patterns as correlated lookups,
upsert snapshots as ``row_number``.
"""

from __future__ import annotations

NL = "chr(10)"

_ITEM_COUNTS = """
  SELECT item_id, pane + to_minutes(5 * (i + 1)) AS window_end, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
               time_bucket(INTERVAL 5 MINUTE, ts) AS pane, count(*) AS c
        FROM events WHERE event_type = 'view' GROUP BY ALL) p
  CROSS JOIN range(12) t(i)
  GROUP BY ALL"""

_ITEM_TOP = f"""
  SELECT item_id, window_end, n, CAST(rn - 1 AS INTEGER) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, item_id) AS rn
        FROM ({_ITEM_COUNTS}) c) r
  WHERE rn <= 5"""

_URL_COUNTS = """
  SELECT url, pane + to_seconds(5 * (i + 1)) AS window_end, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT coalesce(p.url, 'unlisted page ' || (e.event_id % (SELECT count(*) FROM pages))) AS url, time_bucket(INTERVAL 5 SECOND, e.ts) AS pane, count(*) AS c
        FROM events e LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
        WHERE e.event_type = 'click' GROUP BY ALL) u
  CROSS JOIN range(120) t(i)
  GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "hot_items_counts": _ITEM_COUNTS,
    "hot_items_top5": _ITEM_TOP,
    "hot_items_report": f"""
  SELECT window_end,
         '====================================' || {NL} || '时间: '
         || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || {NL}
         || string_agg('No' || rank || ':  商品ID=' || item_id || '  浏览量=' || n || {NL}, '' ORDER BY rank)
         || '====================================' || {NL} || {NL} AS report
  FROM ({_ITEM_TOP}) t GROUP BY window_end""",
    "hot_urls_counts": _URL_COUNTS,
    "hot_urls_top5": f"""
  SELECT url, window_end, n, CAST(rn - 1 AS INTEGER) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, url) AS rn
        FROM ({_URL_COUNTS}) c) r
  WHERE rn <= 5""",
}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_ETL = """
  WITH areas AS (SELECT n.n_name AS country, CASE WHEN n.n_nationkey % 5 = 0 THEN 'WORLD' ELSE r.r_name END AS area
                 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
  SELECT l.l_returnflag AS type, l.l_discount AS score, l.l_linestatus AS level,
         l.l_linenumber AS line, strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt, a.area
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN areas a ON a.country = CASE WHEN o.o_custkey % 10 = 0 THEN '?' || n.n_name ELSE n.n_name END"""

_ORDER_STATUS = """
  WITH s AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'click'),
       e AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'),
       m AS (SELECT s.user_id, s.event_id AS start_event_id, s.ts AS start_ts, s.value AS start_value,
                    n.event_id AS n_event_id, n.ts AS n_ts, n.value AS n_value,
                    coalesce(n.ts < s.ts + INTERVAL 1 HOUR, false) AS paid
             FROM s LEFT JOIN LATERAL (
                 SELECT e.event_id, e.ts, e.value FROM e
                 WHERE e.user_id = s.user_id
                   AND (e.ts > s.ts OR (e.ts = s.ts AND e.event_id > s.event_id))
                 ORDER BY e.ts, e.event_id LIMIT 1) n ON TRUE)
  SELECT user_id, start_event_id, start_ts, start_value,
         CASE WHEN paid THEN n_event_id END AS end_event_id,
         CASE WHEN paid THEN n_ts END AS end_ts,
         CASE WHEN paid THEN n_value END AS end_value,
         CASE WHEN paid THEN 'paid' ELSE 'timeout' END AS status
  FROM m"""

ORACLE.update({
    "parse_behavior": f"""
  SELECT user_id, {_K} AS item_id, {_K} % 10 AS category_id, event_type AS behavior,
         epoch_us(ts) // 1000000 AS ts_seconds,
         make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS event_time
  FROM events""",
    "parse_access_log": """
  SELECT '10.0.' || (e.user_id % 256) || '.' || ((e.event_id % (SELECT count(*) FROM pages)) % 256) AS ip,
         CAST(e.user_id AS VARCHAR) AS user_name, epoch_us(e.ts) // 1000 AS event_ms, 'GET' AS method,
         coalesce(p.url, 'unlisted page ' || (e.event_id % (SELECT count(*) FROM pages))) AS url, make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS event_time
  FROM events e LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
  WHERE e.event_type = 'click'""",
    "dimension_inverted": """
  SELECT n.n_name AS country, CASE WHEN n.n_nationkey % 5 = 0 THEN 'WORLD' ELSE r.r_name END AS area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "etl_enriched": f"SELECT type, score, level, dt, area FROM ({_ETL}) x",
    "etl_enriched_json": f"""
  SELECT '{{"type":"' || type || '","score":' || CAST(score AS VARCHAR)
         || ',"level":"' || level || '","dt":"' || dt || '"'
         || CASE WHEN area IS NULL THEN '' ELSE ',"area":"' || area || '"' END || '}}' AS value
  FROM ({_ETL}) x""",
    "etl_enriched_open_json": f"""
  SELECT '{{"level":"' || level || '","line":' || line || ',"score":'
         || CASE WHEN score = floor(score) THEN CAST(CAST(score AS BIGINT) AS VARCHAR)
                 ELSE CAST(score AS VARCHAR) END
         || ',"type":"' || type || '","dt":"' || dt || '"'
         || CASE WHEN area IS NULL THEN '' ELSE ',"area":"' || area || '"' END || '}}' AS value
  FROM ({_ETL}) x""",
    "adjacent_change": f"""
  WITH e AS (SELECT user_id, event_id, ts, {_K} AS k FROM events WHERE user_id IS NOT NULL),
       l AS (SELECT *, lag(event_id) OVER w AS prev_event_id, lag(ts) OVER w AS prev_ts,
                    lag(k) OVER w AS prev_k, row_number() OVER w AS rn
             FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  SELECT user_id, event_id, ts, k, prev_event_id, prev_ts, prev_k
  FROM l WHERE rn > 1 AND k IS DISTINCT FROM prev_k""",
    "order_status": _ORDER_STATUS,
    "order_paid": f"""
  SELECT user_id, end_event_id AS event_id, end_ts AS ts, end_value AS value
  FROM ({_ORDER_STATUS}) x WHERE status = 'paid'""",
    "order_timeout": f"""
  SELECT user_id, start_event_id AS event_id, start_ts AS ts, start_value AS value
  FROM ({_ORDER_STATUS}) x WHERE status = 'timeout'""",
})

_DECODED = f"""
  WITH e AS (SELECT event_id AS seq, user_id AS id, event_type AS name, event_type,
                    CAST({_K} AS INTEGER) AS age, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS birthday, ts
             FROM events),
       l AS (SELECT *, lag(name) OVER w AS p_name, lag(age) OVER w AS p_age,
                    lag(birthday) OVER w AS p_birthday, row_number() OVER w AS rn
             FROM e WINDOW w AS (PARTITION BY id ORDER BY ts, seq))
  SELECT seq, '+I' AS kind, id, name, age, birthday FROM l WHERE event_type = 'signup'
  UNION ALL SELECT seq, '-D', id, name, age, birthday FROM l WHERE event_type = 'error'
  UNION ALL SELECT seq, '-U', id, p_name, p_age, p_birthday FROM l
            WHERE event_type NOT IN ('signup', 'error') AND rn > 1
  UNION ALL SELECT seq, '+U', id, name, age, birthday FROM l
            WHERE event_type NOT IN ('signup', 'error')"""

_ORDERS_T = """
  SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS partition_day,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
              WHEN o_orderpriority = '3-MEDIUM' THEN 2 ELSE 3 END AS c
  FROM orders"""

_SNAPSHOT = f"""
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, partition_day
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC, c DESC) AS rn
        FROM ({_ORDERS_T}) t) r
  WHERE rn = 1"""

ORACLE.update({
    "changes_decoded": _DECODED,
    "changes_encoded": f"""
  SELECT seq, kind,
         CASE WHEN kind IN ('+I', '+U') THEN '{{"after":' ELSE '{{"before":' END
         || '{{"id":' || id || ',"name":"' || name || '","age":' || age
         || ',"birthday":"' || birthday || '"}},"op":"'
         || CASE WHEN kind IN ('+I', '+U') THEN 'c' ELSE 'd' END || '"}}' AS value
  FROM ({_DECODED}) d""",
    "latest_state": f"""
  SELECT id, name, age, birthday, ts, partition_day
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn
        FROM (SELECT *, make_timestamp((epoch_us(CAST(birthday AS TIMESTAMP)) // 1000) * 1000) AS ts,
                     substring(birthday, 1, 10) AS partition_day
              FROM ({_DECODED}) d WHERE kind IN ('+I', '+U', '-D')) x) r
  WHERE rn = 1 AND kind <> '-D'""",
    "order_derived": """
  SELECT strftime(ts, '%Y%m%d%H%M%S') || substring(strftime(ts, '%f'), 1, 3) || event_id AS orderId,
         CAST(user_id AS VARCHAR) AS userId,
         strftime(ts, '%Y-%m-%d %H:%M:%S.') || substring(strftime(ts, '%f'), 1, 3) AS orderTime,
         '10.0.0.' || (user_id % 256) AS ip, value AS orderMoney,
         CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS INTEGER) AS orderStatus,
         strftime(ts, '%Y%m%d%H%M%S') || substring(strftime(ts, '%f'), 1, 3) AS ts,
         strftime(ts, '%Y-%m-%d') AS partition_day
  FROM events""",
    "upsert_snapshot": _SNAPSHOT,
    "compacted_snapshot": _SNAPSHOT,
    "changes_since": f"""
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         partition_day, 'U' AS _op, CAST(c AS BIGINT) AS _commit
  FROM ({_ORDERS_T}) t WHERE c > 1""",
    "cdc_changes_since": f"""
  SELECT id, name, age, birthday, ts, partition_day, kind AS _op,
         CAST(least((day(ts) - 1) // 10, 2) + 1 AS BIGINT) AS _commit
  FROM (SELECT *, make_timestamp((epoch_us(CAST(birthday AS TIMESTAMP)) // 1000) * 1000) AS ts,
               substring(birthday, 1, 10) AS partition_day FROM ({_DECODED}) d) x
  WHERE least((day(ts) - 1) // 10, 2) + 1 > 1""",
    "stream_change_capture": f"""
  SELECT id, name, age, birthday, substring(birthday, 1, 10) AS partition_day
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY birthday DESC, seq DESC) AS rn
        FROM ({_DECODED}) d WHERE kind IN ('+I', '+U', '-D')) r
  WHERE rn = 1 AND kind <> '-D'""",
    "limit20": f"SELECT * FROM ({_SNAPSHOT}) s ORDER BY o_custkey LIMIT 20",
})

# Streaming forms produce exactly the rows of their batch queries.
ORACLE["login_changes_from_text"] = f"""
  WITH e AS (SELECT user_id, event_id, {_K} AS k FROM events WHERE user_id IS NOT NULL),
       l AS (SELECT *, lag(event_id) OVER w AS prev_event_id, lag(k) OVER w AS prev_k, row_number() OVER w AS rn
             FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
  SELECT user_id, event_id, k, prev_event_id, prev_k FROM l WHERE rn > 1 AND k IS DISTINCT FROM prev_k"""
ORACLE["order_status_from_text"] = """
  WITH ev AS (SELECT user_id, event_id, event_type,
                     CASE WHEN event_id % 97 <> 0 THEN date_trunc('second', ts) END AS ts FROM events),
       m AS (SELECT s.user_id, s.event_id AS start_event_id, s.ts AS start_ts, n.event_id AS n_event_id, n.ts AS n_ts,
                    coalesce(n.ts < s.ts + INTERVAL 1 HOUR, false) AS paid
             FROM ev s LEFT JOIN LATERAL (
                 SELECT e.event_id, e.ts FROM ev e
                 WHERE e.event_type = 'purchase' AND e.user_id = s.user_id
                   AND (e.ts > s.ts OR (e.ts = s.ts AND e.event_id > s.event_id))
                 ORDER BY e.ts, e.event_id LIMIT 1) n ON TRUE
             WHERE s.event_type = 'click')
  SELECT user_id, start_event_id, start_ts, CASE WHEN paid THEN n_event_id END AS end_event_id,
         CASE WHEN paid THEN n_ts END AS end_ts, CASE WHEN paid THEN 'paid' ELSE 'timeout' END AS status
  FROM m"""
for _name in ("hot_items_top5", "hot_urls_top5", "order_status", "order_timeout", "adjacent_change", "etl_enriched",
              "upsert_snapshot", "changes_since"):
    ORACLE[f"stream_{_name}"] = ORACLE[_name]
ORACLE["behavior_text_roundtrip"] = ORACLE["parse_behavior"]
ORACLE["order_table_snapshot"] = ORACLE["order_derived"]
ORACLE["order_table_sql"] = ORACLE["order_derived"]
ORACLE["order_day_sql"] = """
  SELECT strftime(ts, '%Y-%m-%d') AS partition_day, CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS INTEGER) AS orderStatus,
         count(*) AS orders, round(sum(value), 2) AS money
  FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY ALL"""
ORACLE["order_user_snapshot"] = f"""
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, orderId DESC) AS rn
                              FROM ({ORACLE["order_derived"]}) o) r WHERE rn = 1"""
ORACLE["order_status_as_of"] = f"""
  SELECT * REPLACE (CASE WHEN status = 'timeout' AND start_ts + INTERVAL 1 HOUR > (SELECT max(ts) - INTERVAL 1 DAY FROM events)
                         THEN 'pending' ELSE status END AS status)
  FROM ({ORACLE["order_status"]}) o"""
ORACLE["order_status_10s"] = ORACLE["order_status"].replace("INTERVAL 1 HOUR", "INTERVAL 10 SECOND")
ORACLE["stream_etl_lines"] = ORACLE["etl_enriched_json"]
ORACLE["cdc_table_snapshot"] = ORACLE["latest_state"]
ORACLE["stream_login_changes_from_text"] = ORACLE["login_changes_from_text"]
ORACLE["stream_order_table"] = ORACLE["order_table_snapshot"]
