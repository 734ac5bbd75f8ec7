"""DuckDB statements that compute what each registered query must return."""

# --- shared relations ---------------------------------------------------------

_BASE = """
raw AS (
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind, ts, user_id,
         CAST(value AS DECIMAL(18,2)) AS v
  FROM events
),
typed AS (
  SELECT *, CASE WHEN kind = 'view' AND k < 70 THEN 'page_view'
                 WHEN kind = 'view' THEN 'search_query'
                 WHEN kind = 'click' THEN 'product_click'
                 WHEN kind = 'signup' AND k < 60 THEN 'add_to_cart'
                 WHEN kind = 'signup' THEN 'checkout_start'
                 WHEN kind = 'purchase' THEN 'purchase'
                 WHEN kind = 'error' THEN 'refund' END AS event_type
  FROM raw
),
commerce AS (
  SELECT t.event_id, t.event_type, t.ts,
         t.ts + to_milliseconds((t.event_id * 37) % 1000) AS ingest_ts,
         t.user_id, n.n_name AS country, c.c_mktsegment AS device,
         p.p_name AS product_name, p.p_type AS category,
         CASE WHEN t.event_type = 'search_query' THEN concat('q', t.k) END AS query,
         CASE WHEN t.event_type IN ('purchase', 'refund') THEN t.v END AS amount
  FROM typed t
  LEFT JOIN customer c ON c.c_custkey = t.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = t.k
                  AND t.event_type IN ('product_click', 'add_to_cart', 'purchase')
),
deliveries AS (
  SELECT *, 0 AS copy FROM commerce
  UNION ALL
  SELECT * REPLACE (ingest_ts + INTERVAL 10 SECOND AS ingest_ts), 1 FROM commerce WHERE event_id % 500 = 0
  UNION ALL
  SELECT * REPLACE (ingest_ts + INTERVAL 45 SECOND AS ingest_ts), 2 FROM commerce WHERE event_id % 500 = 1
),
firsts AS (
  SELECT * FROM deliveries
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts, copy) = 1
),
timed AS (SELECT *, epoch_us(ingest_ts) AS us FROM deliveries),
kept(event_id, us) AS (
  SELECT event_id, min(us) FROM timed GROUP BY event_id
  UNION ALL
  SELECT k.event_id, min(t.us) FROM kept k JOIN timed t
    ON t.event_id = k.event_id AND t.us >= k.us + 30000000
  GROUP BY k.event_id
),
accepted AS (
  SELECT t.* EXCLUDE (us) FROM timed t JOIN kept k ON k.event_id = t.event_id AND k.us = t.us
  QUALIFY row_number() OVER (PARTITION BY t.event_id, t.us ORDER BY t.copy) = 1
)"""

_LOG = """,
routed AS (
  SELECT *, CAST(CAST('0x' || md5(concat('u_', user_id)) AS UHUGEINT) % 8 AS INTEGER) AS partition_id
  FROM deliveries
),
log AS (
  SELECT *, row_number() OVER (
           PARTITION BY partition_id ORDER BY ingest_ts, CAST(event_id AS VARCHAR), copy) - 1 AS "offset"
  FROM routed
),
stats AS (
  SELECT partition_id, min("offset") AS base_offset, max("offset") + 1 AS end_offset,
         CAST(floor((max("offset") + 1) * 0.9) AS BIGINT) AS committed_offset
  FROM log GROUP BY partition_id
)"""

_KPIS = """,
kpis AS (
  SELECT count(*) AS total_events,
         CAST(coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS total_revenue,
         count(*) FILTER (event_type = 'purchase') AS total_orders,
         count(*) FILTER (event_type = 'refund') AS refunds,
         CAST(coalesce(sum(amount) FILTER (event_type = 'refund'), 0) AS DOUBLE) AS refund_amount
  FROM accepted
)"""

_SECONDS = """,
seconds AS (
  SELECT date_trunc('second', ingest_ts) AS second, count(*) AS event_count FROM accepted GROUP BY 1
),
minutes AS (
  SELECT date_trunc('minute', ingest_ts) AS minute,
         CAST(coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS revenue,
         count(*) FILTER (event_type = 'purchase') AS orders
  FROM accepted GROUP BY 1
)"""

_STAGES = """,
stages AS (
  SELECT s.stage_no, s.stage, (SELECT count(*) FROM accepted a WHERE a.event_type = s.stage) AS event_count
  FROM (VALUES (1, 'page_view'), (2, 'product_click'), (3, 'add_to_cart'), (4, 'checkout_start'),
               (5, 'purchase')) AS s(stage_no, stage)
)"""


def _top_relation(name: str, key: str, k: int, where: str) -> str:
    return f""",
{name} AS (
  SELECT {key}, count(*) AS event_count, min(ingest_ts) AS first_seen
  FROM accepted WHERE {where} GROUP BY {key}
  ORDER BY event_count DESC, first_seen, {key} LIMIT {k}
)"""


_TOPS = (
    _top_relation("products", "product_name", 10, "event_type = 'purchase' AND product_name <> ''")
    + _top_relation("categories", "category", 8, "event_type = 'purchase' AND category <> ''")
    + _top_relation("countries", "country", 10, "country IS NOT NULL")
    + _top_relation("terms", "query", 8, "event_type = 'search_query' AND query IS NOT NULL")
)

# The last 500 arrivals as of the last multiple of 250.
_LATENCY = """,
arrivals AS (
  SELECT row_number() OVER (ORDER BY ingest_ts, event_id) AS no, count(*) OVER () AS n,
         date_diff('microsecond', ts, ingest_ts) / 1000.0 AS ms
  FROM accepted
),
sampled AS (
  SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS place, count(*) OVER () AS m
  FROM arrivals WHERE no <= n - n % 250 AND no > n - n % 250 - 500
),
latency AS (
  SELECT coalesce(round(max(ms) FILTER (place = CAST(floor(m * 0.5) AS BIGINT)), 2), 0.0) AS p50_latency_ms,
         coalesce(round(max(ms) FILTER (place = least(CAST(floor(m * 0.99) AS BIGINT), m - 1)), 2), 0.0)
           AS p99_latency_ms,
         coalesce(round(avg(ms), 2), 0.0) AS avg_latency_ms
  FROM sampled
)"""


def _with(*relations: str, body: str) -> str:
    return f"WITH RECURSIVE {''.join(relations)}\n{body.strip()}"


def _accepted(body: str, *more: str) -> str:
    return _with(_BASE, *more, body=body)


def _log(body: str) -> str:
    return _with(_BASE, _LOG, body=body)


_ROW = "event_id, event_type, ts, ingest_ts, user_id, country, device, product_name, category, query, " \
       "CAST(amount AS DOUBLE) AS amount, copy"
_FIRST = f"SELECT {_ROW} FROM firsts"
_REJECTED = "(SELECT count(*) FROM deliveries) - (SELECT count(*) FROM accepted)"

_STATE = """
SELECT 'total' AS kind, '' AS key, * FROM (SELECT {m} FROM accepted)
UNION ALL SELECT 'event_type', event_type, {m} FROM accepted GROUP BY event_type
UNION ALL SELECT 'product', product_name, {m} FROM accepted
  WHERE event_type = 'purchase' AND product_name <> '' GROUP BY product_name
UNION ALL SELECT 'category', category, {m} FROM accepted
  WHERE event_type = 'purchase' AND category <> '' GROUP BY category
UNION ALL SELECT 'country', country, {m} FROM accepted WHERE country IS NOT NULL GROUP BY country
UNION ALL SELECT 'device', device, {m} FROM accepted WHERE device IS NOT NULL GROUP BY device
UNION ALL SELECT 'query', query, {m} FROM accepted WHERE query IS NOT NULL GROUP BY query
UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), {m} FROM accepted
  WHERE user_id IS NOT NULL GROUP BY user_id
UNION ALL SELECT 'second', CAST(CAST(epoch(date_trunc('second', ingest_ts)) AS BIGINT) AS VARCHAR), {m} FROM accepted
  GROUP BY date_trunc('second', ingest_ts)
UNION ALL SELECT 'minute', CAST(CAST(epoch(date_trunc('minute', ingest_ts)) AS BIGINT) AS VARCHAR), {m} FROM accepted
  GROUP BY date_trunc('minute', ingest_ts)
""".format(m="""count(*) AS events, count(*) FILTER (event_type = 'purchase') AS orders,
  count(*) FILTER (event_type = 'refund') AS refunds,
  CAST(coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS revenue,
  CAST(coalesce(sum(amount) FILTER (event_type = 'refund'), 0) AS DOUBLE) AS refunded,
  min(ingest_ts) AS first_seen""")


def _snapshot(duplicates: str) -> str:
    def series(metric, table, bucket, value, n):
        return f"""
SELECT '{metric}' AS metric, CAST(row_number() OVER (ORDER BY {bucket}) AS INTEGER) AS rank,
       CAST(CAST(epoch({bucket}) AS BIGINT) AS VARCHAR) AS key, CAST({value} AS DOUBLE) AS value
FROM (SELECT * FROM {table} ORDER BY {bucket} DESC LIMIT {n} OFFSET 1)"""

    def leaders(metric, table, key):
        return f"""
SELECT '{metric}', CAST(row_number() OVER (ORDER BY event_count DESC, first_seen, {key}) AS INTEGER),
       {key}, CAST(event_count AS DOUBLE) FROM {table}"""

    def scalar(metric, value, source=""):
        return f"SELECT '{metric}', 0, '', CAST({value} AS DOUBLE) {source}"

    parts = [
        series("revenue_per_minute", "minutes", "minute", "revenue", 20),
        series("orders_per_minute", "minutes", "minute", "orders", 20),
        series("events_per_second", "seconds", "second", "event_count", 30),
        leaders("top_products", "products", "product_name"),
        leaders("top_categories", "categories", "category"),
        leaders("geo_distribution", "countries", "country"),
        leaders("search_terms", "terms", "query"),
        "SELECT 'device_distribution', 0, device, CAST(count(*) AS DOUBLE) FROM accepted "
        "WHERE device IS NOT NULL GROUP BY device",
        "SELECT 'funnel', stage_no, stage, CAST(event_count AS DOUBLE) FROM stages",
        *[scalar(c, c, "FROM kpis") for c in
          ("total_revenue", "total_orders", "total_events", "refunds", "refund_amount")],
        scalar("avg_order_value", "coalesce(round(total_revenue / nullif(total_orders, 0), 2), 0)", "FROM kpis"),
        scalar("active_users", "count(DISTINCT user_id)", "FROM accepted"),
        scalar("current_eps", "event_count", "FROM (SELECT * FROM seconds ORDER BY second DESC LIMIT 1)"),
        scalar("avg_eps_5s", "round(avg(event_count), 2)",
               "FROM (SELECT * FROM seconds ORDER BY second DESC LIMIT 5)"),
        *[scalar(c, c, "FROM latency") for c in ("p50_latency_ms", "p99_latency_ms", "avg_latency_ms")],
        scalar("duplicates_rejected", duplicates),
    ]
    return _accepted("\nUNION ALL\n".join(parts), _KPIS, _SECONDS, _STAGES, _TOPS, _LATENCY)


def _first_n(relation: str, key: str) -> str:
    return _accepted(f"SELECT {key}, event_count, first_seen FROM {relation}", _TOPS)


_HOURLY = """
SELECT time_bucket(INTERVAL 1 HOUR, ingest_ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ingest_ts) + INTERVAL 1 HOUR AS window_end,
       {result} AS result, count(*) AS count
FROM accepted WHERE event_type = 'purchase' GROUP BY 1, 2"""

_STATS_COLUMNS = """partition_id, base_offset, end_offset, committed_offset,
       end_offset - committed_offset AS lag, end_offset AS total_produced, committed_offset AS total_consumed"""

_BAND = """CASE WHEN {v} > {red} THEN 'red' WHEN {v} > {yellow} THEN 'yellow' ELSE 'green' END"""

# State of the engine after each of the four landed time slices.
_HISTORY = """,
spans AS (SELECT epoch_us(min(ingest_ts)) AS lo, epoch_us(max(ingest_ts)) AS hi FROM deliveries),
slices AS (
  SELECT i AS slice, CASE WHEN i = 4 THEN hi + 1 ELSE lo + ((hi - lo) * i) // 4 END AS until_us
  FROM spans, range(1, 5) r(i)
),
upto AS (
  SELECT s.slice, a.*, row_number() OVER (PARTITION BY s.slice ORDER BY a.ingest_ts, a.event_id) AS no,
         count(*) OVER (PARTITION BY s.slice) AS n
  FROM slices s JOIN accepted a ON epoch_us(a.ingest_ts) < s.until_us
),
ranked AS (
  SELECT slice, ms, row_number() OVER (PARTITION BY slice ORDER BY ms) - 1 AS place,
         count(*) OVER (PARTITION BY slice) AS m
  FROM (SELECT slice, no, n, date_diff('microsecond', ts, ingest_ts) / 1000.0 AS ms FROM upto)
  WHERE no <= n - n % 250 AND no > n - n % 250 - 500
),
ranks AS (
  SELECT slice, round(max(ms) FILTER (place = CAST(floor(m * 0.5) AS BIGINT)), 2) AS p50,
         round(max(ms) FILTER (place = least(CAST(floor(m * 0.99) AS BIGINT), m - 1)), 2) AS p99
  FROM ranked GROUP BY slice
),
rates AS (
  SELECT slice, max_by(c, second) AS current_eps, round(avg(c), 2) AS avg_eps_5s
  FROM (SELECT slice, date_trunc('second', ingest_ts) AS second, count(*) AS c FROM upto GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY slice ORDER BY second DESC) <= 5)
  GROUP BY slice
)"""


def oracle_sql() -> dict[str, str]:
    rolling = _accepted(f"SELECT {_ROW} FROM accepted")
    log_row = 'SELECT event_id, copy, partition_id, "offset" FROM log'
    return {
        # event log
        "route_by_key": _log("SELECT event_id, copy, partition_id FROM routed"),
        "route_round_robin": _accepted(
            "SELECT event_id, copy, n AS send_no, CAST(n % 8 AS INTEGER) AS partition_id FROM (SELECT *, "
            "row_number() OVER (ORDER BY ingest_ts, event_id, copy) - 1 AS n FROM deliveries)"),
        "assign_offsets": _log(log_row),
        "log_append": _log(log_row),
        "log_scan": _log("""
SELECT partition_id, "offset", CAST(event_id AS VARCHAR) AS event_id, event_type, ts AS timestamp,
       concat('u_', user_id) AS user_id, concat('s_', user_id) AS session_id,
       concat('u_', user_id) AS partition_key, country, device, product_name, category, query,
       CAST(amount AS DOUBLE) AS amount
FROM log"""),
        "replay": _log("""
SELECT partition_id, "offset", event_id, event_type, ts AS timestamp FROM log
WHERE partition_id = 3 AND "offset" >= greatest(20, 50) ORDER BY "offset" LIMIT 100"""),
        "retain_newest_half": _log("""
SELECT l.partition_id, l."offset", l.event_id, l.copy FROM log l
JOIN (SELECT partition_id, count(*) AS n FROM log GROUP BY 1) s USING (partition_id)
WHERE l."offset" >= s.n // 2"""),
        "stream_append": _log(log_row),
        "retain_by_statistics": _log("""
SELECT l.partition_id, l."offset", l.event_id, l.copy FROM log l
JOIN (SELECT partition_id, count(*) AS n FROM log GROUP BY 1) s USING (partition_id)
WHERE l."offset" >= s.n // 2"""),
        "stream_bounded_events": _log("""
SELECT "offset" // 256 AS poll, partition_id, count(*) AS events, min("offset") AS first_offset,
       max("offset") AS last_offset
FROM log GROUP BY ALL"""),
        "consumer_stats": _log("""
SELECT partition_id, 0 AS base_offset, end_offset, c AS committed_offset, end_offset - c AS lag,
       end_offset AS total_produced, c AS total_consumed, greatest(0, end_offset - 100) AS backpressure_events
FROM (SELECT CAST(r.range AS INTEGER) AS partition_id, count("offset") AS end_offset, least(200, count("offset")) AS c
      FROM range(8) r LEFT JOIN log ON partition_id = r.range GROUP BY 1)"""),
        "consumer_totals": _log("""
SELECT CAST(sum(n) AS BIGINT) AS total_produced, CAST(sum(least(200, n)) AS BIGINT) AS total_consumed,
       CAST(sum(n - least(200, n)) AS BIGINT) AS queue_lag, sum(n - least(200, n)) > 50000 AS lag_alert,
       CAST(sum(greatest(0, n - 100)) AS BIGINT) AS backpressure_events
FROM (SELECT partition_id, count(*) AS n FROM log GROUP BY 1)"""),
        "partition_stats": _log(f"SELECT {_STATS_COLUMNS} FROM stats"),
        "broker_totals": _log("""
SELECT CAST(sum(end_offset) AS BIGINT) AS total_produced, CAST(sum(committed_offset) AS BIGINT) AS total_consumed,
       CAST(sum(end_offset - committed_offset) AS BIGINT) AS queue_lag, sum(end_offset - committed_offset) > 50000 AS lag_alert
FROM stats"""),
        "shard_rollup": _log("""
SELECT partition_id % 3 AS shard_id, count(*) AS partitions, CAST(sum(committed_offset) AS BIGINT) AS processed,
       CAST(sum(CASE WHEN partition_id = 0 THEN 2 ELSE 0 END) AS BIGINT) AS errors,
       CAST(sum(end_offset - committed_offset) AS BIGINT) AS queue_lag
FROM stats GROUP BY 1"""),
        "health_bands": _log(f"""
SELECT concat('partition-', partition_id) AS unit, lag, least(100.0, lag / 10000.0 * 100) AS lag_pct,
       {_BAND.format(v="least(100.0, lag / 10000.0 * 100)", red=70, yellow=30)} AS band
FROM (SELECT partition_id, end_offset - committed_offset AS lag FROM stats)
UNION ALL
SELECT concat('shard-', shard_id), lag, least(100.0, lag / 10000.0 * 100),
       {_BAND.format(v="lag", red=5000, yellow=1000)}
FROM (SELECT partition_id % 3 AS shard_id, CAST(sum(end_offset - committed_offset) AS BIGINT) AS lag
      FROM stats GROUP BY 1)"""),
        "state_log_scan": _accepted("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, user_id, ingest_ts AS ts, CAST(amount AS DOUBLE) AS amount
FROM (SELECT event_id, event_type, concat('u_', user_id) AS user_id, ingest_ts, amount FROM accepted)
WHERE event_id % 7 <> 0"""),
        # pipeline
        "pipe_filter": _accepted(
            "SELECT event_id, user_id, CAST(amount AS DOUBLE) AS amount FROM accepted WHERE event_type = 'purchase'"),
        "pipe_map": _accepted("SELECT CAST(amount AS DOUBLE) AS value FROM accepted WHERE amount IS NOT NULL"),
        "pipe_filter_map": _accepted(
            "SELECT CAST(coalesce(amount, 0) AS DOUBLE) AS value FROM accepted WHERE event_type = 'purchase'"),
        "pipe_window_sum": _accepted(_HOURLY.format(result="CAST(sum(coalesce(amount, 0)) AS DOUBLE)")),
        "pipe_window_udaf": _accepted(_HOURLY.format(
            result="CAST(max(CAST(amount * 100 AS BIGINT)) - min(CAST(amount * 100 AS BIGINT)) AS DOUBLE) / 100")),
        "pipe_window_median": _accepted("""
SELECT time_bucket(INTERVAL 1 DAY, ingest_ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ingest_ts) + INTERVAL 1 DAY AS window_end,
       CAST(median(CAST(coalesce(amount, 0) * 100 AS BIGINT)) AS DOUBLE) AS result, count(*) AS count
FROM accepted WHERE event_type = 'purchase' GROUP BY 1, 2"""),
        # metrics
        "kpi_totals": _accepted("""
SELECT total_events, total_revenue, total_orders,
       coalesce(round(total_revenue / nullif(total_orders, 0), 2), 0) AS avg_order_value, refunds, refund_amount
FROM kpis""", _KPIS),
        "active_users_approx": _accepted(
            "SELECT count(DISTINCT user_id) AS active_users, true AS within_5_pct FROM accepted"),
        "active_users": _accepted("SELECT count(DISTINCT user_id) AS active_users FROM accepted"),
        "funnel": _accepted("SELECT stage_no, stage, event_count FROM stages", _STAGES),
        "top_products": _first_n("products", "product_name"),
        "top_categories": _accepted(
            "SELECT category, split_part(category, ' ', 1) AS label, event_count, first_seen FROM categories",
            _TOPS),
        "geo_distribution": _first_n("countries", "country"),
        "device_distribution": _accepted(
            "SELECT device, count(*) AS event_count FROM accepted WHERE device IS NOT NULL GROUP BY device"),
        "top_search_terms": _first_n("terms", "query"),
        "metrics_snapshot": _snapshot(_REJECTED),
        # time series
        "revenue_per_minute": _accepted("SELECT minute, revenue FROM minutes", _SECONDS),
        "orders_per_minute": _accepted("SELECT minute, orders FROM minutes", _SECONDS),
        "events_per_second": _accepted("SELECT second, event_count FROM seconds", _SECONDS),
        "recent_buckets": _accepted("""
SELECT 'revenue_per_minute' AS series, minute AS bucket, revenue AS value
FROM (SELECT * FROM minutes ORDER BY minute DESC LIMIT 20 OFFSET 1)
UNION ALL
SELECT 'orders_per_minute', minute, CAST(orders AS DOUBLE)
FROM (SELECT * FROM minutes ORDER BY minute DESC LIMIT 20 OFFSET 1)
UNION ALL
SELECT 'events_per_second', second, CAST(event_count AS DOUBLE)
FROM (SELECT * FROM seconds ORDER BY second DESC LIMIT 30 OFFSET 1)""", _SECONDS),
        "current_rate": _accepted("""
SELECT max_by(event_count, second) AS current_eps, round(avg(event_count), 2) AS avg_eps_5s
FROM (SELECT * FROM seconds ORDER BY second DESC LIMIT 5)""", _SECONDS),
        "rolling_rate": _accepted("""
SELECT second, event_count, round(avg(event_count) OVER (
  ORDER BY second ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 2) AS avg_eps_5s FROM seconds""", _SECONDS),
        "latency_percentiles": _accepted("SELECT * FROM latency", _LATENCY),
        # derived
        "funnel_conversion": _accepted("""
SELECT stage_no, stage, event_count,
       CASE WHEN stage_no > 1 THEN round(CAST(event_count AS DOUBLE) / greatest(lag(event_count) OVER w, 1) * 100, 1)
       END AS step_pct,
       CAST(event_count AS DOUBLE) / greatest(max(event_count) OVER (), 1) * 100 AS pct_of_max
FROM stages WINDOW w AS (ORDER BY stage_no)""", _STAGES),
        "geo_share": _accepted("""
SELECT country, event_count, round(CAST(event_count AS DOUBLE) / total * 100, 1) AS share_pct
FROM (SELECT *, sum(event_count) OVER () AS total FROM countries)
ORDER BY event_count DESC, first_seen, country LIMIT 6""", _TOPS),
        "device_share": _accepted("""
SELECT device, event_count, round(CAST(event_count AS DOUBLE) / sum(event_count) OVER () * 100, 1) AS share_pct
FROM (SELECT device, count(*) AS event_count FROM accepted WHERE device IS NOT NULL GROUP BY device)"""),
        "product_relative": _accepted("""
SELECT product_name, event_count, CAST(event_count AS DOUBLE) / max(event_count) OVER () * 100 AS pct_of_leader
FROM (SELECT * FROM products ORDER BY event_count DESC, first_seen, product_name LIMIT 8)""", _TOPS),
        "refund_rate": _accepted("""
SELECT refunds, total_orders, CASE WHEN total_orders > 0
  THEN round(CAST(refunds AS DOUBLE) / total_orders * 100, 1) ELSE 0.0 END AS refund_rate_pct
FROM kpis""", _KPIS),
        # dedup and state
        "dedup_first": _accepted(_FIRST),
        "dedup_window": rolling,
        "dedup_report": _with(_BASE, body="""
SELECT d AS delivered, a AS accepted, d - a AS duplicates_rejected, i AS duplicates_injected,
       least(100, CAST(round((d - a) / i * 100) AS BIGINT)) AS dedup_effectiveness_pct
FROM (SELECT (SELECT count(*) FROM timed) AS d, (SELECT count(*) FROM kept) AS a,
             (SELECT count(*) FROM timed WHERE copy > 0) AS i)"""),
        "incremental_merge": _accepted(_STATE),
        "snapshot_roundtrip": _accepted(_STATE),
        "compact_partials": _accepted(_STATE),
        # streams
        "stream_bounded_read": _accepted(f"SELECT {_ROW} FROM deliveries"),
        "stream_sink": _accepted(f"SELECT {_ROW} FROM deliveries WHERE event_type = 'purchase'"),
        "stream_restart_dedup": _accepted(_FIRST),
        "stream_dedup_exact": rolling,
        "stream_maintain": _accepted(_STATE + f"""
UNION ALL SELECT 'duplicates', '', {_REJECTED}, 0, 0, 0, 0, TIMESTAMP '1970-01-01'"""),
        "stream_dedup_bounded": _accepted("""
SELECT arrival, event_id, copy, ingest_ts, a.event_id IS NULL AS is_duplicate
FROM deliveries d LEFT JOIN accepted a USING (event_id, copy, ingest_ts)
CROSS JOIN (VALUES ('in time'), ('newest first'), ('resends first')) AS o(arrival)"""),
        "stream_maintain_bounded": _accepted(_STATE + f"""
UNION ALL SELECT 'duplicates', '', {_REJECTED}, 0, 0, 0, 0, TIMESTAMP '1970-01-01'"""),
        "stream_late_rows": _with(_BASE, body="""
SELECT count(*) AS events, count(*) FILTER (event_type = 'purchase') AS orders,
       count(*) FILTER (event_type = 'refund') AS refunds,
       CAST(coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS revenue,
       CAST(coalesce(sum(amount) FILTER (event_type = 'refund'), 0) AS DOUBLE) AS refunded
FROM commerce"""),
        "stream_late_resends": _accepted(f"""
SELECT 'total' AS kind, total_events AS events, total_orders AS orders, refunds, total_revenue AS revenue,
       refund_amount AS refunded FROM kpis
UNION ALL SELECT 'duplicates', {_REJECTED}, 0, 0, 0, 0""", _KPIS),
        "stream_users_of_week": _accepted("""
SELECT day, count(DISTINCT user_id) AS users, count(user_id) AS events, true AS within_bounds
FROM (SELECT DISTINCT CAST(ingest_ts AS DATE) AS day FROM accepted WHERE user_id IS NOT NULL)
JOIN accepted ON CAST(ingest_ts AS DATE) BETWEEN day - 6 AND day
GROUP BY day"""),
        "stream_top_k": _accepted("""
SELECT kind, place, key, event_count, first_seen, true AS proven
FROM (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY event_count DESC, first_seen, key) AS place
  FROM (SELECT kind, key, count(*) AS event_count, min(ingest_ts) AS first_seen
        FROM accepted, LATERAL (VALUES
          ('product', CASE WHEN event_type = 'purchase' THEN nullif(product_name, '') END),
          ('category', CASE WHEN event_type = 'purchase' THEN nullif(category, '') END),
          ('country', country), ('query', query)) AS e(kind, key)
        WHERE key IS NOT NULL GROUP BY kind, key))
WHERE place <= CASE WHEN kind IN ('product', 'country') THEN 10 ELSE 8 END"""),
        "stream_publish": _snapshot(_REJECTED),
        "metric_history": _accepted("""
SELECT CAST(slice - 1 AS BIGINT) AS sample_no, current_eps, avg_eps_5s, p50 AS p50_latency_ms, p99 AS p99_latency_ms
FROM rates JOIN ranks USING (slice)""", _HISTORY),
        "stream_progress": _with(_BASE, body="""
, passed AS (SELECT (epoch_us(max(ingest_ts)) // 1000 - 30000) * 1000 AS us FROM commerce)
SELECT count(*) AS input_rows, count(*) FILTER (copy = 1 AND epoch_us(ingest_ts) > us) AS dropped,
       count(*) FILTER (copy = 1 AND epoch_us(ingest_ts) <= us) AS late
FROM deliveries, passed WHERE copy < 2"""),
        "stream_revised_windows": _with(_BASE, body="""
, timed_commerce AS (
  SELECT *, epoch_us(ingest_ts) AS us, min(epoch_us(ingest_ts)) OVER () AS lo, max(epoch_us(ingest_ts)) OVER () AS hi
  FROM commerce),
arrived AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, ingest_ts) AS w,
         CASE WHEN us >= lo + (hi - lo) * 2 // 3 OR event_id % 10 = 3 THEN 2 WHEN us >= lo + (hi - lo) // 3 THEN 1 ELSE 0 END AS b
  FROM timed_commerce),
times AS (SELECT b, max(us) AS us FROM arrived GROUP BY b),
clock AS (SELECT b, max(us) OVER (ORDER BY b) AS now, lag(us) OVER (ORDER BY b) AS previous FROM times),
sums AS (
  SELECT c.b, w, coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS result, count(*) AS count,
         count(*) FILTER (a.b = c.b) AS fresh, any_value(now) AS now, any_value(previous) AS previous
  FROM clock c JOIN arrived a ON a.b <= c.b GROUP BY c.b, w)
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, row_number() OVER (PARTITION BY w ORDER BY b) - 1 AS revision,
       CAST(result AS DOUBLE) AS result, CAST(count AS BIGINT) AS count
FROM sums
WHERE epoch_us(w + INTERVAL 1 DAY) <= now
  AND (previous IS NULL OR epoch_us(w + INTERVAL 1 DAY) > previous OR fresh > 0)"""),
        "stream_window": _accepted("""
SELECT time_bucket(INTERVAL 1 DAY, ingest_ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ingest_ts) + INTERVAL 1 DAY AS window_end,
       CAST(coalesce(sum(amount) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS result, count(*) AS count
FROM firsts
WHERE time_bucket(INTERVAL 1 DAY, ingest_ts) + INTERVAL 1 DAY
      <= (SELECT max(ingest_ts) - INTERVAL 30 SECOND FROM firsts)
GROUP BY 1, 2"""),
    }
