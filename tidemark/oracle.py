"""The same queries as SQL over the supplied tables, to compare results with."""

from __future__ import annotations

SESSION_US = 1800 * 1000000

_MAPPED = """
mapped AS (
  SELECT event_id AS n, ts, CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) AS user_id, k, CAST(k AS VARCHAR) AS product_id,
         CASE WHEN event_type = 'signup' THEN 'add_to_cart'
              WHEN event_type = 'view' AND k % 2 = 0 THEN 'product_view'
              WHEN event_type = 'view' THEN 'page_view'
              ELSE event_type END AS event_type,
         ['desktop', 'mobile', 'tablet'][CAST(user_id % 3 AS INTEGER) + 1] AS device,
         CAST(value AS DECIMAL(18,2)) AS sale_price
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username, r_name AS country,
         n_name AS city, c_mktsegment AS user_segment, c_acctbal >= 0 AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey
),
goods AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS product_name,
         p_brand AS brand, p_type AS category, p_size, p_retailprice
  FROM part
),
everything AS (
  SELECT e.event_id, e.event_type, e.ts, e.user_id, e.product_id, e.sale_price,
         e.device,
         CAST(CASE WHEN e.event_type = 'purchase' THEN 1 + e.n % 5
                   WHEN e.event_type = 'add_to_cart' THEN 1 + e.n % 3
                   ELSE 1 END AS INTEGER) AS quantity,
         CAST(CASE WHEN e.event_type IN ('product_view', 'click')
                   THEN 5 + e.n % 296 END AS INTEGER) AS time_on_page_sec,
         u.user_segment, u.country, u.city, p.sku, p.category, p.brand,
         CAST(e.ts AS DATE) AS event_date
  FROM mapped e LEFT JOIN people u USING (user_id) LEFT JOIN goods p USING (product_id)
),
clean AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN sale_price * quantity ELSE 0 END AS amount
  FROM everything
  WHERE event_type IN ('page_view', 'product_view', 'search', 'click', 'add_to_cart',
                       'remove_from_cart', 'wishlist_add', 'purchase', 'review_submit')
)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([_MAPPED.strip(), *[c.strip() for c in ctes]]) + "\n" + body


# -- metric rows --------------------------------------------------------------

_MINUTES = """
minutes AS (
  SELECT w AS window_start, w + INTERVAL 1 MINUTE AS window_end,
         CAST(count(*) AS DOUBLE) AS events,
         CAST(count(DISTINCT user_id) AS DOUBLE) AS users,
         CAST(sum(amount) AS DOUBLE) AS revenue,
         CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) AS clicks,
         CAST(count(*) FILTER (event_type = 'add_to_cart') AS DOUBLE) AS carts,
         CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) AS purchases
  FROM (SELECT *, date_trunc('minute', ts) AS w FROM clean) GROUP BY w
)"""


# Which sixth of the time an event falls into; every twentieth of the first half comes three later.
_PIECES = """
bounds AS (SELECT min(ts) AS low, max(ts) AS high FROM events),
on_time AS (
  SELECT * FROM clean, bounds
  WHERE NOT (CAST(event_id AS BIGINT) % 20 = 0
             AND epoch_us(ts) < epoch_us(low)
                 + CAST(round((epoch_us(high) - epoch_us(low)) / 6.0) AS BIGINT) * 3)
)"""
_ON_TIME_MINUTES = _MINUTES.replace("FROM clean)", "FROM on_time)")


# A stream writes a minute once in each piece that has events of it.
_PIECE_OF_MINUTES = """
piece_minutes AS (
  SELECT DISTINCT date_trunc('minute', ts) AS w,
         least(5, (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events))
                  // CAST(round(((SELECT epoch_us(max(ts)) FROM events)
                                 - (SELECT epoch_us(min(ts)) FROM events)) / 6.0) AS BIGINT)) AS piece
  FROM clean
)"""


def _minute_metric(name: str, column: str, key: str) -> str:
    return f"""
  SELECT window_start, window_end, '1m' AS window_type, '{name}' AS metric_name,
         {column} AS metric_value, '{key}' AS dimension_key, '' AS dimension_value
  FROM minutes"""


_USERS_1M = _minute_metric("active_users_1m", "users", "users")
_COUNTS_1M = " UNION ALL ".join(
    [
        _minute_metric("events_1m", "events", "events"),
        _minute_metric("revenue_1m", "revenue", "revenue"),
        _minute_metric("click_1m", "clicks", "click"),
        _minute_metric("cart_1m", "carts", "add_to_cart"),
        _minute_metric("purchase_1m", "purchases", "purchase"),
    ]
)
_SUMMARY_1M = _COUNTS_1M + " UNION ALL " + _USERS_1M

_SLIDING = """
slid AS (
  SELECT clean.*, date_trunc('minute', ts) - to_minutes(back) AS w
  FROM clean CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS back) AS b
)"""


def _rate(name: str, part: str, whole: str) -> str:
    return f"""
  SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, '5m' AS window_type,
         '{name}' AS metric_name,
         CASE WHEN count(*) FILTER (event_type = '{whole}') > 0
              THEN CAST(count(*) FILTER (event_type = '{part}') AS DOUBLE)
                   / count(*) FILTER (event_type = '{whole}')
              ELSE 0.0 END AS metric_value,
         '' AS dimension_key, '' AS dimension_value
  FROM slid GROUP BY w"""


_CONVERSION = _rate("conversion_rate", "purchase", "click")
_CART = _rate("add_to_cart_rate", "add_to_cart", "product_view")
_RATES = _CONVERSION + " UNION ALL " + _CART

_TIME_ON_PAGE = """
  SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, '5m' AS window_type,
         'avg_time_on_page' AS metric_name, avg(time_on_page_sec) AS metric_value,
         'category' AS dimension_key, coalesce(category, '') AS dimension_value
  FROM slid
  WHERE event_type IN ('product_view', 'click') AND time_on_page_sec IS NOT NULL
  GROUP BY w, category"""

_HOURS = """
hours AS (SELECT *, date_trunc('hour', ts) AS w FROM clean)"""


def _hourly(name: str, value: str, column: str, only: str = "TRUE") -> str:
    return f"""
  SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, '1h' AS window_type,
         '{name}' AS metric_name, CAST({value} AS DOUBLE) AS metric_value,
         '{column}' AS dimension_key, coalesce({column}, '') AS dimension_value
  FROM hours WHERE {only} GROUP BY w, {column}"""


_REVENUE_1H = _hourly("revenue_by_category", "sum(amount)", "category", "event_type = 'purchase'")
_PURCHASES_1H = _hourly("product_purchase_count", "count(*)", "sku", "event_type = 'purchase'")
_CLICKS_1H = _hourly("product_click_count", "count(*)", "sku", "event_type = 'click'")
_CARTS_1H = _hourly("product_add_to_cart_count", "count(*)", "sku", "event_type = 'add_to_cart'")
_SEGMENTS_1H = _hourly("segment_distribution", "count(*)", "user_segment")
_DEVICES_1H = _hourly("device_distribution", "count(*)", "device")
_COUNTRIES_1H = _hourly("country_distribution", "count(*)", "country")
_HOURLY = " UNION ALL ".join([_SEGMENTS_1H, _REVENUE_1H, _PURCHASES_1H, _CLICKS_1H])

_PRODUCT_REVENUE_1H = _hourly("product_revenue", "sum(amount)", "sku", "event_type = 'purchase'")

_NEWEST_FIRST = (
    "ORDER BY window_start DESC, window_type, metric_name, dimension_key, dimension_value"
)

_MESSAGES = f"""
  SELECT '{{"window_start":"' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
      || '","window_end":"' || strftime(window_end, '%Y-%m-%d %H:%M:%S')
      || '","window_type":"' || window_type || '","metric_name":"' || metric_name
      || '","metric_value":"' || CAST(metric_value AS VARCHAR)
      || '","dimension_key":"' || dimension_key
      || '","dimension_value":"' || dimension_value || '"}}' AS value
  FROM ({_COUNTS_1M})"""

_SNAPSHOT = """
  SELECT metric_name, coalesce(arg_max(metric_value, window_start), 0.0) AS metric_value
  FROM rows_in GROUP BY metric_name"""

_BOARDS = f"""
boards AS (
  SELECT CASE metric_name WHEN 'product_purchase_count' THEN 'top:products:purchase'
                          WHEN 'product_click_count' THEN 'top:products:click'
                          ELSE 'top:products:revenue' END AS leaderboard,
         dimension_value AS member, arg_max(metric_value, window_start) AS score
  FROM ({_PURCHASES_1H} UNION ALL {_CLICKS_1H} UNION ALL {_PRODUCT_REVENUE_1H})
  WHERE dimension_value <> '' GROUP BY ALL
)"""

# -- sessions -------------------------------------------------------------------

_SESSIONS = f"""
gaps AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER u) < {SESSION_US} THEN 0 ELSE 1 END
            AS starts
  FROM clean WINDOW u AS (PARTITION BY user_id ORDER BY ts)
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no
  FROM gaps
),
user_sessions AS (
  SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
         epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us,
         arg_min(user_segment, ts) AS user_segment
  FROM numbered GROUP BY user_id, no
)"""

_SESSION_ROWS = """
  SELECT user_id, session_start, session_end, event_count,
         duration_us / 1000000.0::DOUBLE AS duration_sec
  FROM user_sessions"""

# -- marts ------------------------------------------------------------------------


def _count(event_type: str) -> str:
    return f"count(*) FILTER (event_type = '{event_type}')"


def _div(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0.0 END"


_REVENUE = "CAST(sum(amount) AS DOUBLE)"

_DAILY = f"""
daily AS (
  SELECT event_date AS date, count(*) AS total_events, {_count('purchase')} AS total_purchases,
         {_REVENUE} AS total_revenue, count(DISTINCT user_id) AS unique_users,
         {_div(_count('purchase'), _count('click'))} AS conversion_rate,
         {_div(_REVENUE, _count('purchase'))} AS avg_order_value
  FROM clean GROUP BY event_date
)"""

_PRODUCTS = f"""
product_days AS (
  SELECT c.event_date AS date, c.product_id, g.product_name, g.category,
         {_count('product_view')} AS view_count, {_count('click')} AS click_count,
         {_count('add_to_cart')} AS cart_count, {_count('purchase')} AS purchase_count,
         {_REVENUE} AS revenue,
         {_div(_count('purchase'), _count('click'))} AS conversion_rate
  FROM clean c LEFT JOIN goods g USING (product_id)
  GROUP BY c.event_date, c.product_id, g.product_name, g.category
)"""

_SEGMENTS = f"""
segment_days AS (
  SELECT event_date AS date, user_segment, count(DISTINCT user_id) AS user_count,
         count(*) AS event_count, {_count('purchase')} AS purchase_count, {_REVENUE} AS revenue
  FROM clean GROUP BY event_date, user_segment
),
lengths AS (
  SELECT CAST(session_start AS DATE) AS date, user_segment,
         CAST(sum(duration_us) AS DOUBLE) / (count(*) * 1000000.0::DOUBLE) AS seconds
  FROM user_sessions GROUP BY ALL
),
segments AS (
  SELECT s.*, coalesce(l.seconds, 0.0) AS avg_session_duration
  FROM segment_days s LEFT JOIN lengths l
    ON s.date = l.date AND s.user_segment IS NOT DISTINCT FROM l.user_segment
)"""

_FUNNEL = f"""
funnel AS (
  SELECT event_date AS date, category, {_count('page_view')} AS page_view_count,
         {_count('product_view')} AS product_view_count, {_count('click')} AS click_count,
         {_count('add_to_cart')} AS add_to_cart_count, {_count('purchase')} AS purchase_count,
         {_div(_count('click'), _count('product_view'))} AS view_to_click_rate,
         {_div(_count('add_to_cart'), _count('click'))} AS click_to_cart_rate,
         {_div(_count('purchase'), _count('add_to_cart'))} AS cart_to_purchase_rate
  FROM clean GROUP BY event_date, category
)"""

_GEO = f"""
geo AS (
  SELECT event_date AS date, country, city, count(*) AS event_count,
         {_count('purchase')} AS purchase_count, {_REVENUE} AS revenue
  FROM clean GROUP BY event_date, country, city
)"""

_HOURLY_KPI = f"""
hourly_kpi AS (
  SELECT w AS hour_start, count(*) AS total_events, {_count('purchase')} AS purchases,
         {_REVENUE} AS revenue, count(DISTINCT user_id) AS active_users
  FROM hours GROUP BY w
)"""

# -- checks -----------------------------------------------------------------------


def _check(table: str, column: str, check: str, severity: str, source: str, bad: str) -> str:
    return f"""
  SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name,
         '{severity}' AS severity, count(*) FILTER ({bad}) AS failures
  FROM {source}"""


def _unique_check(table: str, column: str, source: str) -> str:
    repeated = (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL"
        f" GROUP BY {column} HAVING count(*) > 1)"
    )
    return _check(table, column, "unique", "error", repeated, "TRUE")


def _null_check(table: str, column: str, source: str) -> str:
    return _check(table, column, "not_null", "error", source, f"{column} IS NULL")


def _sign_check(table: str, column: str, source: str) -> str:
    return _check(table, column, "non_negative", "warn", source, f"{column} < 0")


def _rate_check(table: str, column: str, source: str) -> str:
    return _check(table, column, "valid_rate", "warn", source, f"{column} < 0 OR {column} > 1")


_STAGING_TYPES = "('click', 'add_to_cart', 'remove_from_cart', 'purchase', 'page_view', 'search')"

_MART_CHECKS = " UNION ALL ".join(
    [
        _null_check("mart_daily_summary", "date", "daily"),
        _sign_check("mart_daily_summary", "total_revenue", "daily"),
        _rate_check("mart_daily_summary", "conversion_rate", "daily"),
        _unique_check("mart_daily_summary", "date", "daily"),
        _null_check("mart_product_performance", "product_id", "product_days"),
        _sign_check("mart_product_performance", "revenue", "product_days"),
        _rate_check("mart_product_performance", "conversion_rate", "product_days"),
        _null_check("mart_user_segments", "user_segment", "segments"),
        _sign_check("mart_user_segments", "revenue", "segments"),
        _null_check("mart_funnel_analysis", "category", "funnel"),
        _rate_check("mart_funnel_analysis", "view_to_click_rate", "funnel"),
        _rate_check("mart_funnel_analysis", "click_to_cart_rate", "funnel"),
        _rate_check("mart_funnel_analysis", "cart_to_purchase_rate", "funnel"),
        _null_check("mart_geo_revenue", "country", "geo"),
        _sign_check("mart_geo_revenue", "revenue", "geo"),
        _null_check("mart_hourly_kpi", "hour_start", "hourly_kpi"),
        _sign_check("mart_hourly_kpi", "revenue", "hourly_kpi"),
        _unique_check("mart_hourly_kpi", "hour_start", "hourly_kpi"),
    ]
)

_MART_TOTALS = " UNION ALL ".join(
    f"""
  SELECT '{mart}' AS mart, {day} AS date, count(*) AS row_count,
         CAST(sum({events}) AS BIGINT) AS events, CAST(sum({purchases}) AS BIGINT) AS purchases,
         CAST(round(sum({amount}), 2) AS DOUBLE) AS amount
  FROM {source} GROUP BY ALL"""
    for mart, source, day, events, purchases, amount in (
        ("mart_daily_summary", "daily", "date", "total_events", "total_purchases", "total_revenue"),
        ("mart_product_performance", "product_days", "date", "click_count", "purchase_count", "revenue"),
        ("mart_user_segments", "segments", "date", "event_count", "purchase_count", "revenue"),
        ("mart_funnel_analysis", "funnel", "date", "click_count", "purchase_count", "add_to_cart_count"),
        ("mart_geo_revenue", "geo", "date", "event_count", "purchase_count", "revenue"),
        ("mart_hourly_kpi", "hourly_kpi", "CAST(hour_start AS DATE)", "total_events", "purchases", "revenue"),
    )
)

_REASON = """CASE WHEN event_id IS NULL THEN 'Null Event ID'
              WHEN user_id IS NULL THEN 'Null User ID'
              WHEN event_type NOT IN ('page_view', 'product_view', 'search', 'click',
                   'add_to_cart', 'remove_from_cart', 'wishlist_add', 'purchase',
                   'review_submit') THEN 'Invalid Event Type'
              WHEN ts IS NULL THEN 'Null Timestamp' END"""

_PRICE = "CAST(sale_price AS DOUBLE) AS sale_price"


def _wow(name: str) -> str:
    old = f"CAST(b.{name} AS DOUBLE)"
    return f"""b.{name} AS {name}_last_week,
         CASE WHEN {old} <> 0 THEN (a.{name} - {old}) / {old} * 100.0::DOUBLE END AS {name}_wow"""


def oracle_sql() -> dict[str, str]:
    counts = _with(_MINUTES, body=_COUNTS_1M)
    rates = _with(_SLIDING, body=_RATES)
    hourly = _with(_HOURS, body=_HOURLY)
    clean_ids = _with(body="SELECT event_id, event_type, ts AS timestamp FROM clean")
    segments = _with(_SESSIONS, _SEGMENTS, body="SELECT * FROM segments")
    hourly_kpi = _with(_HOURS, _HOURLY_KPI, body="SELECT * FROM hourly_kpi")
    snapshot_1m = _with(_MINUTES, f"rows_in AS ({_SUMMARY_1M})", body=_SNAPSHOT)
    daily = _with(_DAILY, body="SELECT * FROM daily")
    messages = _with(_MINUTES, body=_MESSAGES)
    all_metrics = _with(
        _MINUTES,
        _SLIDING,
        _HOURS,
        body=" UNION ALL ".join([_SUMMARY_1M, _RATES, _TIME_ON_PAGE, _HOURLY]),
    )
    places = _with(
        _MINUTES,
        _SLIDING,
        _HOURS,
        f"""metric_rows AS (
              {' UNION ALL '.join([_SUMMARY_1M, _RATES, _TIME_ON_PAGE, _HOURLY])})""",
        body=f"""SELECT 'raw_events' AS place, event_id AS member, CAST(NULL AS DOUBLE) AS value
                 FROM clean
                 UNION ALL SELECT 'dead_letters', event_id, NULL FROM everything
                           WHERE {_REASON} IS NOT NULL
                 UNION ALL SELECT metric_name, dimension_value, metric_value FROM metric_rows""",
    )
    return {
        "a1_event_stream": _with(
            body="SELECT event_id, event_type, user_id, ts AS timestamp FROM everything"
        ),
        "a2_event_schema": _with(
            body=f"""SELECT event_id, ts AS timestamp, user_segment AS segment, country, sku,
                            {_PRICE}, quantity FROM everything"""
        ),
        "a3_table_sources": _with(
            body="""SELECT 'raw_events' AS table_name, event_id AS c0, event_type AS c1,
                           user_id AS c2 FROM clean
                    UNION ALL SELECT 'users', user_id, username, user_segment FROM people
                    UNION ALL SELECT 'products', product_id, sku, category FROM goods"""
        ),
        "a4_active_users": _with(
            body="""SELECT user_id, username, user_segment, country, city,
                           CAST(NULL AS VARCHAR) AS preferred_device, CAST(NULL AS VARCHAR) AS os,
                           CAST(NULL AS VARCHAR) AS preferred_language, is_active
                    FROM people WHERE is_active"""
        ),
        "a5_available_products": _with(
            body="""SELECT product_id, sku, product_name, brand, category AS category_name,
                           CAST(NULL AS VARCHAR) AS subcategory,
                           CAST(coalesce(CAST(p_retailprice AS DECIMAL(18,2)), 0) AS DOUBLE)
                             AS sale_price,
                           CAST(NULL AS VARCHAR) AS currency,
                           CAST(coalesce(nullif(p_size % 4, 0), 1) AS INTEGER) AS popularity_score
                    FROM goods WHERE p_size % 7 <> 0"""
        ),
        "b1_parse_json": _with(
            body="""SELECT event_id, event_type, ts AS timestamp, ts AS kafka_timestamp
                    FROM everything"""
        ),
        "b2_flatten": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, user_id, user_segment, country,
                            city, product_id, sku, category, brand, {_PRICE}, quantity,
                            time_on_page_sec FROM everything"""
        ),
        "b3_validate": _with(body=f"SELECT event_id, {_REASON} AS error_reason FROM everything"),
        "b1_unknown_fields": _with(
            body="""SELECT event_id, event_type,
                           CASE WHEN CAST(event_id AS BIGINT) % 3 = 0
                                THEN CAST(CAST(event_id AS BIGINT) % 5 AS INTEGER) END AS campaign,
                           CASE WHEN CAST(event_id AS BIGINT) % 3 = 0
                                THEN 't' || CAST(CAST(event_id AS BIGINT) % 2 AS VARCHAR) END AS tag
                    FROM clean"""
        ),
        "b4_route": _with(
            body=f"""SELECT event_id, event_type,
                            CASE WHEN {_REASON} IS NULL THEN 'clean' ELSE 'dead_letter' END AS route
                     FROM everything"""
        ),
        "b5_stored_form": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, event_date, user_id,
                            user_segment, country, product_id, category AS category_name, {_PRICE},
                            quantity, CAST(NULL AS INTEGER) AS position_in_list, time_on_page_sec
                     FROM clean"""
        ),
        "b6_unpivot": counts,
        "b7_metric_rows": _with(_HOURS, body=_CARTS_1H),
        "b8_safe_ratio": _with(
            body=f"""SELECT event_date, product_id,
                            {_div(_count('purchase'), _count('click'))} AS rate
                     FROM clean GROUP BY event_date, product_id"""
        ),
        "b9_metric_messages": messages,
        "b10_stg_events": _with(
            body="""SELECT event_id, event_type, ts AS timestamp, event_date, user_id,
                           user_segment, quantity FROM clean"""
        ),
        "b11_stg_users": _with(
            body="""SELECT user_id, username, upper(trim(country)) AS country, city,
                           lower(trim(user_segment)) AS user_segment FROM people"""
        ),
        "b12_stg_products": _with(
            body="""SELECT product_id, product_name,
                           CAST(len(string_split(product_name, ' ')) AS INTEGER) AS tag_count,
                           string_split(product_name, ' ')[1] AS first_tag,
                           p_size % 5 <> 0 AND p_size % 3 > 0 AS is_on_sale FROM goods"""
        ),
        "c1_summary_1m": _with(_MINUTES, body=_SUMMARY_1M),
        "c2_conversion_rate_5m": _with(_SLIDING, body=_CONVERSION),
        "c3_add_to_cart_rate_5m": _with(_SLIDING, body=_CART),
        "c23_rates_5m": rates,
        "c4_time_on_page_5m": _with(_SLIDING, body=_TIME_ON_PAGE),
        "c5_revenue_by_category_1h": _with(_HOURS, body=_REVENUE_1H),
        "c6_product_purchases_1h": _with(_HOURS, body=_PURCHASES_1H),
        "c7_segment_distribution_1h": _with(_HOURS, body=_SEGMENTS_1H),
        "c1_user_sketches": _with(
            _SLIDING,
            body="""SELECT w AS window_start, CAST(count(DISTINCT user_id) AS DOUBLE) AS users, true AS within
                    FROM slid GROUP BY w""",
        ),
        "m1_daily_from_minutes": _with(
            _DAILY, body="SELECT * EXCLUDE (unique_users), true AS within FROM daily"
        ),
        "m6_hours_from_minutes": f"SELECT * EXCLUDE (active_users), true AS within FROM ({hourly_kpi})",
        "c8_top_products_stream": _with(
            _HOURS,
            body=f"""SELECT * FROM (
                       SELECT window_start, dimension_value AS sku,
                              CAST(metric_value AS BIGINT) AS purchase_count,
                              CAST(row_number() OVER (PARTITION BY window_start
                                ORDER BY metric_value DESC, dimension_value) AS INTEGER) AS position
                       FROM ({_PURCHASES_1H})) WHERE position <= 10""",
        ),
        "c8_top_products_1h": _with(
            _HOURS,
            body=f"""SELECT * FROM (
                       SELECT window_start, dimension_value AS sku,
                              metric_value AS purchase_count,
                              CAST(row_number() OVER (PARTITION BY window_start
                                ORDER BY metric_value DESC, dimension_value) AS INTEGER) AS position
                       FROM ({_PURCHASES_1H})) WHERE position <= 10""",
        ),
        "c_all_metrics": all_metrics,
        "s1_watermarked_counts": counts,
        "s2_sliding_stream": rates,
        "s2_tumbling_stream": hourly,
        "s2_active_users_stream": _with(_MINUTES, body=_USERS_1M),
        "s3_sessions": _with(_SESSIONS, body=_SESSION_ROWS),
        "s3_session_stream": _with(
            _SESSIONS,
            body=_SESSION_ROWS,
        ),
        "s4_output_modes": _with(
            body="""SELECT mode, date_trunc('minute', ts) AS window_start,
                           event_type AS dimension_value, CAST(count(*) AS DOUBLE) AS metric_value
                    FROM clean CROSS JOIN (SELECT unnest(['append', 'update']) AS mode) AS modes
                    GROUP BY ALL"""
        ),
        "s5_trigger": _with(body="SELECT event_id, event_type FROM clean"),
        "s6_state_rows": _with(
            body="""SELECT 'counts_1m' AS query, 'stateStoreSave' AS operator, count(DISTINCT date_trunc('minute', ts)) AS rows
                    FROM clean
                    WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE > (SELECT max(ts) FROM clean) - INTERVAL 5 MINUTE"""
        ),
        "s7_late_data": _with(_PIECES, _ON_TIME_MINUTES, body=_COUNTS_1M),
        "s6_restart": counts,
        "s8_stream_dedup": clean_ids,
        "s9_all_streams": places,
        "s9_one_read": places,
        "s7_late_in_sums": all_metrics,
        "s7_repaired_windows": counts,
        "d1_raw_events": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, event_date, user_id,
                            user_segment, country, product_id, category AS category_name, {_PRICE},
                            quantity, time_on_page_sec FROM clean"""
        ),
        "d1_event_store": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, event_date, user_id,
                            user_segment, country, product_id, category AS category_name, {_PRICE},
                            quantity, time_on_page_sec FROM clean"""
        ),
        "d1_late_events": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, event_date, user_id,
                            user_segment, country, product_id, category AS category_name, {_PRICE},
                            quantity, time_on_page_sec FROM clean"""
        ),
        "d1_late_daily_summary": daily,
        "d2_point_read": _with(
            _HOURS,
            body=f"""SELECT window_start, dimension_value, metric_value FROM ({_HOURLY})
                     WHERE metric_name = 'product_click_count' AND dimension_value = 'SKU-7'""",
        ),
        "d2_metric_upsert": _with(_HOURS, body=_SEGMENTS_1H),
        "d3_kpi_snapshot": _with(
            _MINUTES,
            _SLIDING,
            f"rows_in AS ({_SUMMARY_1M} UNION ALL {_RATES})",
            body=_SNAPSHOT,
        ),
        "d4_leaderboards": _with(_HOURS, _BOARDS, body="SELECT * FROM boards"),
        "d5_metric_messages": messages,
        "d6_dead_letters": _with(
            body=f"""SELECT event_id, event_type, ts AS timestamp, {_REASON} AS error_reason,
                            event_id AS sent_id
                     FROM everything WHERE {_REASON} IS NOT NULL"""
        ),
        "d6_dead_letter_messages": _with(
            body=f"""SELECT {_REASON} AS error_reason, event_id, event_type
                     FROM everything WHERE {_REASON} IS NOT NULL"""
        ),
        "d7_batch_audit": _with(
            _MINUTES,
            _PIECE_OF_MINUTES,
            body="""SELECT 'refresh' AS event, 'counts_1m' AS query,
                           CAST(5 * count(*) AS BIGINT) AS metrics_count,
                           count(DISTINCT piece) AS batches FROM piece_minutes
                    UNION ALL SELECT 'refresh', 'active_users_1m', count(*), count(DISTINCT piece)
                    FROM piece_minutes""",
        ),
        "d9_empty_batch": _with(
            _HOURS,
            body=f"""SELECT CAST(1 AS BIGINT) AS batch_id, count(*) AS metrics_count,
                            count(*) AS stored FROM ({_SEGMENTS_1H})""",
        ),
        "d8_inserted_rows": _with(body="SELECT user_id, username, user_segment FROM people"),
        "d8_insert_absent": _with(
            body="""SELECT 0 AS step, 'users' AS table_name,
                           count(*) FILTER (is_active) AS inserted,
                           CAST(0 AS BIGINT) AS skipped FROM people
                    UNION ALL
                    SELECT 1, 'users', count(*) FILTER (NOT is_active),
                           count(*) + count(*) FILTER (is_active) FROM people
                    UNION ALL SELECT 2, 'products', count(*), 0 FROM goods
                    UNION ALL SELECT 3, 'products', 0, count(*) FROM goods"""
        ),
        "m1_daily_summary": daily,
        "m2_product_performance": _with(_PRODUCTS, body="SELECT * FROM product_days"),
        "m3_user_segments": segments,
        "m4_funnel_analysis": _with(_FUNNEL, body="SELECT * FROM funnel"),
        "m5_geo_revenue": _with(_GEO, body="SELECT * FROM geo"),
        "m6_hourly_kpi": hourly_kpi,
        "q1_not_null": _with(
            body=" UNION ALL ".join(
                _null_check("raw_events", c, "everything")
                for c in ("event_id", "user_id", "time_on_page_sec")
            )
        ),
        "q2_unique": _with(
            body=" UNION ALL ".join(
                _unique_check("raw_events", c, "everything") for c in ("event_id", "user_id")
            )
        ),
        "q3_accepted_values": _with(
            body=_check(
                "raw_events",
                "event_type",
                "accepted_values",
                "warn",
                "everything",
                f"event_type NOT IN {_STAGING_TYPES}",
            )
        ),
        "q4_relationships": _with(
            body=" UNION ALL ".join(
                [
                    _check(
                        "raw_events",
                        "product_id",
                        "relationship",
                        "error",
                        "(SELECT e.product_id FROM everything e ANTI JOIN"
                        " (SELECT product_id FROM goods WHERE p_size % 7 <> 0) g"
                        " USING (product_id))",
                        "TRUE",
                    ),
                    _check(
                        "raw_events",
                        "user_id",
                        "relationship",
                        "error",
                        "(SELECT e.user_id FROM everything e ANTI JOIN"
                        " (SELECT user_id FROM people WHERE is_active) p USING (user_id))",
                        "TRUE",
                    ),
                ]
            )
        ),
        "q5_non_negative": _with(
            _HOURS,
            _HOURLY_KPI,
            body=_sign_check("mart_hourly_kpi", "revenue", "hourly_kpi")
            + " UNION ALL "
            + _sign_check("customer", "c_acctbal", "customer"),
        ),
        "q6_valid_rate": _with(
            _SLIDING, body=_rate_check("conversion_rate", "metric_value", f"({_CONVERSION})")
        ),
        "q7_mart_checks": _with(
            _DAILY, _PRODUCTS, _SESSIONS, _SEGMENTS, _FUNNEL, _GEO, _HOURS, _HOURLY_KPI,
            body=_MART_CHECKS,
        ),
        "q8_data_ready": _with(
            body="""SELECT d.day, EXISTS (SELECT 1 FROM clean WHERE event_date = d.day) AS ready
                    FROM (SELECT min(event_date) - 1 AS day FROM clean
                          UNION ALL SELECT min(event_date) FROM clean
                          UNION ALL SELECT max(event_date) FROM clean) d"""
        ),
        "p1_daily_run": daily,
        "p1_known_ids": _with(
            """bounds AS (SELECT min(event_date) AS low, max(event_date) AS high FROM clean),
               cut AS (SELECT low + CAST((high - low) * 2 // 3 AS INTEGER) AS start FROM bounds)""",
            body="""SELECT event_id, event_date < start AS known FROM clean, cut
                    WHERE event_date >= start OR CAST(event_id AS BIGINT) % 7 = 0""",
        ),
        "p1_daily_marts": _with(
            _DAILY, _PRODUCTS, _SESSIONS, _SEGMENTS, _FUNNEL, _GEO, _HOURS, _HOURLY_KPI,
            body=_MART_TOTALS,
        ),
        "p3_delta_daily": daily,
        "p3_delta_marts": _with(
            _DAILY, _PRODUCTS, _SESSIONS, _SEGMENTS, _FUNNEL, _GEO, _HOURS, _HOURLY_KPI,
            body=f"""SELECT * FROM ({_MART_TOTALS})
                     WHERE mart IN ('mart_daily_summary', 'mart_product_performance',
                                    'mart_funnel_analysis', 'mart_hourly_kpi')""",
        ),
        "p3_emptied_date": _with(
            _DAILY,
            body="SELECT * FROM daily WHERE date <> (SELECT max(event_date) - 1 FROM clean)",
        ),
        "p2_hourly_run": hourly_kpi,
        "p3_incremental_rebuild": segments,
        "r1_summary": snapshot_1m,
        "r2_timeseries": _with(
            _MINUTES,
            body=f"""SELECT window_start, metric_name, metric_value, dimension_key, dimension_value
                     FROM ({_SUMMARY_1M}) {_NEWEST_FIRST} LIMIT 100""",
        ),
        "r2_timeseries_range": _with(
            _HOURS,
            body=f"""SELECT window_start, metric_name, metric_value, dimension_key, dimension_value
                     FROM ({_HOURLY})
                     WHERE window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00'
                                            AND TIMESTAMP '2024-01-10 12:00:00'
                     {_NEWEST_FIRST} LIMIT 200""",
        ),
        "r3_top_products": _with(
            _HOURS,
            _BOARDS,
            body="""SELECT member AS product_id, score FROM boards
                    WHERE leaderboard = 'top:products:click'
                    ORDER BY score DESC, member DESC LIMIT 10""",
        ),
        "r3_live_top_products": _with(
            _HOURS,
            _BOARDS,
            body="""SELECT member AS product_id, score FROM boards
                    WHERE leaderboard = 'top:products:purchase'
                    ORDER BY score DESC, member DESC LIMIT 5""",
        ),
        "r3_top_products_by_revenue": _with(
            _HOURS,
            _BOARDS,
            body="""SELECT member AS product_id, score FROM boards
                    WHERE leaderboard = 'top:products:revenue'
                    ORDER BY score DESC, member DESC LIMIT 10""",
        ),
        "r9_event_types": _with(
            body="""SELECT date_trunc('minute', ts) AS window_start, event_type,
                           CAST(count(*) AS DOUBLE) AS events FROM clean GROUP BY ALL"""
        ),
        "r10_kpi_now": _with(
            _SLIDING,
            body="""SELECT
              (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) FROM slid
               WHERE w = (SELECT max(w) FROM slid)) AS active_users,
              (SELECT CAST(sum(amount) AS DOUBLE) FROM clean
               WHERE event_date = (SELECT max(event_date) FROM clean)) AS revenue_today,
              (SELECT CASE WHEN count(*) FILTER (event_type = 'click') > 0
                           THEN CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE)
                                / count(*) FILTER (event_type = 'click') ELSE 0.0 END FROM slid
               WHERE w = (SELECT max(w) FROM slid)) AS conversion_rate"""
        ),
        "r4_breakdown": _with(
            _SLIDING,
            _HOURS,
            body=f"""SELECT window_start, metric_name, metric_value, dimension_value
                     FROM ({_REVENUE_1H} UNION ALL {_TIME_ON_PAGE}) {_NEWEST_FIRST} LIMIT 100""",
        ),
        "r5_daily_report": _with(
            _DAILY, body="SELECT * FROM daily ORDER BY date DESC LIMIT 30"
        ),
        "r6_funnel_report": _with(
            _FUNNEL, body="SELECT * FROM funnel ORDER BY date DESC, category LIMIT 30"
        ),
        "r7_product_report": _with(
            _PRODUCTS, body="SELECT * FROM product_days ORDER BY date DESC, product_id LIMIT 100"
        ),
        "r8_live_chart": _with(
            _MINUTES,
            body="""SELECT window_start, clicks AS click_count, purchases AS purchase_count, revenue
                    FROM minutes""",
        ),
        "r9_event_rate": _with(
            _MINUTES,
            body="SELECT window_start, round(floor(events) / 60, 1) AS events_per_sec FROM minutes",
        ),
        "r10_kpi_cards": _with(
            _MINUTES,
            body="""SELECT CAST(floor(coalesce(nullif(events, 0), clicks, 0)) AS BIGINT)
                             AS total_events,
                           CAST(floor(users) AS BIGINT) AS active_users,
                           CAST(floor(revenue) AS BIGINT) AS revenue,
                           CAST(floor(purchases) AS BIGINT) AS purchases
                    FROM minutes ORDER BY window_start DESC LIMIT 1""",
        ),
        "r11_daily_revenue": _with(
            _DAILY,
            body="""SELECT strftime(date, '%m-%d') AS label, total_revenue / 1000 AS revenue_k
                    FROM (SELECT * FROM daily ORDER BY date DESC LIMIT 30)""",
        ),
        "w1_kpi_change": _with(
            _MINUTES,
            body=f"""SELECT window_start, window_type, metric_name, dimension_key, dimension_value,
                            metric_value, previous_value,
                            CASE WHEN previous_value <> 0
                                 THEN (metric_value - previous_value) / abs(previous_value)
                                      * 100.0::DOUBLE END AS change_percent
                     FROM (SELECT a.*, b.metric_value AS previous_value
                           FROM ({_COUNTS_1M}) a LEFT JOIN ({_COUNTS_1M}) b
                             ON b.metric_name = a.metric_name
                            AND b.window_start = a.window_start - INTERVAL 1 MINUTE)""",
        ),
        "w2_rank_change": _with(
            _HOURS,
            f"""ranked AS (
                  SELECT window_start, dimension_value AS sku, metric_value AS n,
                         row_number() OVER (PARTITION BY window_start
                                            ORDER BY metric_value DESC, dimension_value) AS position,
                         rank() OVER (PARTITION BY window_start ORDER BY metric_value DESC) AS rank
                  FROM ({_PURCHASES_1H}))""",
            body="""SELECT a.window_start, a.sku, a.n AS purchase_count,
                           CAST(a.position AS INTEGER) AS position, CAST(a.rank AS INTEGER) AS rank,
                           b.rank AS previous_rank, b.rank - a.rank AS rank_change
                    FROM ranked a LEFT JOIN ranked b
                      ON b.sku = a.sku AND b.window_start = a.window_start - INTERVAL 1 HOUR
                    WHERE a.position <= 10""",
        ),
        "w3_week_over_week": _with(
            _DAILY,
            body=f"""SELECT a.date, a.total_events, a.total_purchases, a.total_revenue,
                            a.unique_users, {_wow('total_events')}, {_wow('total_purchases')},
                            {_wow('total_revenue')}, {_wow('unique_users')}
                     FROM daily a LEFT JOIN daily b ON b.date = a.date - 7""",
        ),
        "w4_country_breakdown": _with(_HOURS, body=_COUNTRIES_1H),
        "w4_device_breakdown": _with(_HOURS, body=_DEVICES_1H),
        "w5_rolling_volume": _with(
            _MINUTES,
            body="""SELECT window_start, clicks AS click, carts AS add_to_cart,
                           purchases AS purchase FROM minutes
                    WHERE window_start > (SELECT max(window_start) FROM minutes)
                                         - INTERVAL 30 MINUTE""",
        ),
        "w6_revenue_by_hour": _with(
            body=f"""SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, {_REVENUE} AS revenue
                     FROM clean GROUP BY ALL""",
        ),
    }
