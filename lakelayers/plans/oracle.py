"""The registered queries as plain SQL over the given tables.

Written for an engine with its own rounding of doubles, so money is rounded and
summed as decimals and turned into doubles last.
"""

from __future__ import annotations

# Raw store orders and customers, and the bronze orders of all stores.
_RAW = """
raw AS (
  SELECT o_orderkey AS id,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 72) AS updated_at,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24) AS processed_at,
         o_custkey AS customer_id,
         'c' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email,
         CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'partially_paid' END
           AS financial_status,
         CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
         o_totalprice AS amount,
         CASE c_nationkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'GBP' ELSE 'EUR' END AS currency,
         CASE c_nationkey % 4 WHEN 0 THEN 'yoga-us' WHEN 1 THEN 'yoga-canada' WHEN 2 THEN 'yoga-uk'
                              ELSE 'yoga-intl' END AS platform
  FROM orders JOIN customer ON o_custkey = c_custkey
),
raw_customers AS (
  SELECT c_custkey AS customer_id,
         CASE c_nationkey % 4 WHEN 0 THEN 'yoga-us' WHEN 1 THEN 'yoga-canada' WHEN 2 THEN 'yoga-uk'
                              ELSE 'yoga-intl' END AS platform,
         n_name AS country,
         c_acctbal AS balance,
         TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS updated_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


def _bronze(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT id AS order_id, created_at, CAST(created_at AS DATE) AS created_at_date, updated_at, processed_at,
         customer_id, email, financial_status, fulfillment_status,
         CAST(round(CAST(amount AS DECIMAL(18,4)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS total_price,
         currency, platform
  FROM {source}
)"""


_CHANGES = """
raw_changes AS (
  SELECT * REPLACE (updated_at + INTERVAL 10 YEAR AS updated_at, 'refunded' AS financial_status)
  FROM raw WHERE id % 10 = 0
  UNION ALL
  SELECT * REPLACE (-id AS id) FROM raw WHERE id % 100 = 1
)"""

_BASE = f"WITH {_RAW},{_bronze('raw', 'bronze')}"
_CHANGED = f"{_BASE},{_CHANGES},{_bronze('raw_changes', 'changes')}"
_MERGED = f"""{_CHANGED},
merged AS (
  SELECT * FROM bronze b
  WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.order_id = b.order_id AND c.platform = b.platform)
  UNION ALL SELECT * FROM changes
)"""

_DAILY = """
SELECT created_at_date, platform, currency, count(*) AS orders,
       CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM {table} WHERE financial_status = 'paid' GROUP BY created_at_date, platform, currency"""

_HISTORY = """
SELECT 'bronze.orders' AS table_name, '{metric}' AS metric, CAST(created_at_date AS TIMESTAMP) AS run_at,
       {value} AS metric_value
FROM bronze GROUP BY created_at_date"""
_STORE_TABLE = """CASE platform WHEN 'yoga-us' THEN 'bronze.br_shopify_us_orders' WHEN 'yoga-canada' THEN 'bronze.br_shopify_can_orders'
  WHEN 'yoga-uk' THEN 'bronze.br_shopify_uk_orders' ELSE 'bronze.br_shopify_intl_orders' END"""
_METRIC = f"""
SELECT {_STORE_TABLE} AS table_name, '{{metric}}' AS metric, TIMESTAMP '2002-01-01' AS run_at, {{value}} AS metric_value
FROM bronze GROUP BY platform"""
_MEAN = "CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) / count(total_price)"
_ROWS = "CAST(count(*) AS DOUBLE)"

_SEED = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price"""

_DUPLICATES = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

_DATE_FAILS = "created_at_date < DATE '2000-01-01' OR created_at_date > DATE '2000-01-01' + 365"

_CHECKS = f"""
SELECT 'orders' AS table_name, 'order_id' AS column_name, 'not_null' AS test,
       (SELECT count(*) FROM bronze WHERE order_id IS NULL) AS failures
UNION ALL SELECT 'orders', 'order_id', 'unique',
       (SELECT count(*) FROM (SELECT order_id FROM bronze GROUP BY order_id HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'fulfillment_status', 'not_null',
       (SELECT count(*) FROM bronze WHERE fulfillment_status IS NULL)
UNION ALL SELECT 'orders', 'created_at_date', 'is_valid_date', (SELECT count(*) FROM bronze WHERE {_DATE_FAILS})
UNION ALL SELECT 'orders', 'total_price', 'non_negative', (SELECT count(*) FROM bronze WHERE total_price < 0)
UNION ALL SELECT 'customers', 'customer_id', 'not_null',
       (SELECT count(*) FROM raw_customers WHERE customer_id IS NULL)
UNION ALL SELECT 'customers', 'balance', 'non_negative', (SELECT count(*) FROM raw_customers WHERE balance < 0)
UNION ALL SELECT 'lineitem', 'l_orderkey, l_linenumber', 'unique', (SELECT count(*) FROM ({_DUPLICATES}))"""

_STORE_NAMES = {
    "yoga-us": "src_shopify_us",
    "yoga-canada": "src_shopify_can",
    "yoga-uk": "src_shopify_uk",
    "yoga-intl": "src_shopify_intl",
}
_STORE_TABLES = ("order_line", "products", "product_variant")
_EMPTY = {
    **{source: _STORE_TABLES for source in _STORE_NAMES.values()},
    "src_shopify_us": (*_STORE_TABLES, "refund", "order_adjustment", "fulfillment"),
    "src_braze": (
        "users_messages_email_send", "users_messages_email_open", "users_messages_email_click", "users_messages_push_send"
    ),
    "src_salesforce": ("account", "contact", "opportunity", "lead"),
}
# Each load, and how many hours old it may be before a warning and before an error.
_LOADS = "\nUNION ALL ".join(
    [
        f"SELECT '{source}' AS source, '{table}' AS table_name, max(updated_at) + INTERVAL 1 HOUR AS max_loaded_at, "
        f"12 AS warn, 24 AS error FROM {relation} WHERE platform = '{store}'"
        for table, relation in (("orders", "raw"), ("customers", "raw_customers"))
        for store, source in _STORE_NAMES.items()
    ]
    + ["SELECT 'src_ga4', 'events', CAST(max(ts) AS TIMESTAMP), 12, 24 FROM events"]
    + [
        f"SELECT '{source}', '{table}', CAST(NULL AS TIMESTAMP), {'24, 48' if source == 'src_salesforce' else '12, 24'}"
        for source, tables in _EMPTY.items() for table in tables
    ]
)

# A day on: refunds of a tenth and some new orders, all of them late.
_NEXT_DAY = f"""{_BASE},
late AS (
  SELECT * REPLACE ('refunded' AS financial_status) FROM bronze WHERE order_id % 10 = 0
  UNION ALL SELECT * REPLACE (-order_id AS order_id) FROM bronze WHERE order_id % 100 = 1
),
day_after AS (SELECT * FROM bronze WHERE order_id % 10 <> 0 UNION ALL SELECT * FROM late)"""

_MONTHLY = f"""{_BASE}
SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS month, platform, currency,
       CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM bronze WHERE financial_status = 'paid' GROUP BY 1, 2, 3"""

# Watermarks are in milliseconds: what is not after one is too late.
_ARRIVALS = """
WITH lots AS (
  SELECT *, event_id % 7 = 0 AND ts < TIMESTAMP '2024-01-21' AS held FROM events
), one AS (
  SELECT * FROM lots WHERE NOT held AND ts < TIMESTAMP '2024-01-11'
), two AS (
  SELECT * FROM lots WHERE NOT held AND ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'
  UNION ALL
  SELECT * REPLACE (ts + INTERVAL 240 HOUR AS ts) FROM one
  WHERE event_id % 10 = 5 AND ts < (SELECT max(ts) FROM one) - INTERVAL 12 HOUR - INTERVAL 2 DAY
), marks AS (
  SELECT (SELECT epoch_ms(max(ts)) - 12 * 3600000 FROM one) * 1000 AS first_mark,
         (SELECT epoch_ms(max(ts)) - 12 * 3600000 FROM two) * 1000 AS second_mark
), late AS (
  SELECT (SELECT count(*) FROM one WHERE event_id % 10 = 0 AND epoch_us(ts) <= first_mark)
       + (SELECT count(*) FROM lots WHERE held AND epoch_us(ts) <= second_mark) AS too_late
  FROM marks
), kept AS (
  SELECT * FROM one UNION ALL SELECT * FROM two
  UNION ALL SELECT lots.* FROM lots, marks WHERE held AND epoch_us(ts) > second_mark
  UNION ALL SELECT * FROM lots WHERE ts >= TIMESTAMP '2024-01-21'
)
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props, too_late FROM kept, late"""

ORACLE: dict[str, str] = {
    "scan_source_orders": f"""{_BASE}
SELECT id, created_at, updated_at, processed_at, customer_id, email, financial_status, fulfillment_status,
       amount, currency AS currency_code, currency, updated_at + INTERVAL 1 HOUR AS _fivetran_synced
FROM raw WHERE platform = 'yoga-us'""",
    "bronze_orders": f"{_BASE} SELECT * FROM bronze WHERE platform = 'yoga-us'",
    "cents_to_dollars": """
SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS dollars,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(0.01 AS DECIMAL(3,2)), 1) AS DOUBLE) AS dollars_1
FROM lineitem""",
    "case_map_status": f"""{_BASE}
SELECT order_id, financial_status, fulfillment_status,
       CASE financial_status WHEN 'paid' THEN 'closed' WHEN 'pending' THEN 'open' ELSE 'other' END AS payment_group,
       CASE WHEN fulfillment_status = 'fulfilled' THEN 'shipped' ELSE 'waiting' END AS shipping_group
FROM bronze""",
    "platform_dims": f"""{_BASE}
SELECT order_id, platform,
       CASE platform WHEN 'yoga-us' THEN 'USD' WHEN 'yoga-canada' THEN 'CAD' WHEN 'yoga-uk' THEN 'GBP'
                     WHEN 'yoga-intl' THEN 'EUR' END AS platform_currency,
       CASE platform WHEN 'yoga-us' THEN 'US' WHEN 'yoga-canada' THEN 'CA' WHEN 'yoga-uk' THEN 'UK'
                     WHEN 'yoga-intl' THEN 'INTL' END AS platform_code
FROM bronze""",
    "seed_products": f"{_SEED} FROM part",
    "seed_column_types": "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_retailprice AS price FROM part",
    "products_with_tax": f"{_SEED}, round(p_retailprice * CAST(1.1 AS DOUBLE), 2) AS price_with_tax FROM part",
    "cutoff_filter": f"""{_BASE}
SELECT order_id, platform, created_at_date FROM bronze WHERE created_at_date >= DATE '1998-12-30'""",
    "cutoff_events": """
SELECT event_id, CAST(ts AS TIMESTAMP) AS event_timestamp, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-16'""",
    "local_business_date": f"""{_BASE},
zoned AS (
  SELECT order_id, processed_at,
         timezone('America/Los_Angeles', timezone('UTC', processed_at)) AS local_processed_at FROM bronze
)
SELECT *, CAST(local_processed_at AS DATE) AS local_processed_date FROM zoned""",
    "union_stores": f"{_BASE} SELECT * FROM bronze",
    "stream_store_union": f"{_BASE} SELECT customer_id, platform, country, balance, updated_at FROM raw_customers",
    "silver_dedup": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "silver_customers": f"""{_BASE}, delivered AS (
  SELECT * FROM raw_customers
  UNION ALL SELECT * REPLACE (updated_at - INTERVAL 1 DAY AS updated_at, balance + 1000.0 AS balance)
  FROM raw_customers WHERE customer_id % 5 = 0
)
SELECT customer_id, platform, country, balance, updated_at FROM (
  SELECT *, row_number() OVER (
    PARTITION BY platform, customer_id ORDER BY updated_at DESC, country DESC, balance DESC) AS rn
  FROM delivered) WHERE rn = 1""",
    "silver_orders_enriched": f"""{_BASE}
SELECT b.*, c.country AS customer_country, c.balance AS customer_balance
FROM bronze b LEFT JOIN raw_customers c ON c.platform = b.platform AND c.customer_id = b.customer_id""",
    "revenue_by_month": _MONTHLY,
    "gold_revenue_daily": _BASE + _DAILY.format(table="bronze"),
    "high_water_mark": f"{_BASE} SELECT platform, max(updated_at) AS high_water FROM bronze GROUP BY platform",
    "stored_high_water_mark": f"{_BASE} SELECT platform, max(updated_at) AS high_water FROM bronze GROUP BY platform",
    "incremental_filter": f"""{_BASE}
SELECT * FROM bronze
WHERE updated_at > (SELECT max(updated_at) FROM bronze WHERE created_at_date < DATE '1998-07-01')""",
    "incremental_lookback": f"""{_BASE}
SELECT order_id, updated_at FROM bronze
WHERE updated_at > (SELECT max(updated_at) - INTERVAL 2 DAY FROM bronze WHERE created_at_date < DATE '1998-07-01')""",
    "incremental_merge": f"{_MERGED} SELECT * FROM merged",
    "full_refresh": f"{_BASE} SELECT * FROM bronze",
    "table_rebuild": f"{_SEED}, round(p_retailprice * CAST(1.1 AS DOUBLE), 2) AS price_with_tax FROM part",
    "view_model": f"""{_BASE}, daily AS ({_DAILY.format(table="bronze")})
SELECT platform, CAST(sum(orders) AS BIGINT) AS orders, count(*) AS days FROM daily GROUP BY platform""",
    "view_of_view": f"""{_MERGED},
streamed AS (
  SELECT * REPLACE (
    CASE order_id % 10 WHEN 5 THEN 'streamed' WHEN 7 THEN 'zzz' WHEN 8 THEN 'keyless' END AS financial_status,
    CASE WHEN order_id % 10 <> 8 THEN order_id END AS order_id)
  FROM bronze WHERE platform = 'yoga-us' AND order_id % 10 IN (5, 7, 8)
),
latest AS (
  SELECT * FROM merged WHERE NOT (platform = 'yoga-us' AND order_id % 10 IN (5, 7)) UNION ALL SELECT * FROM streamed
)
SELECT c.country AS customer_country, m.financial_status, count(*) AS orders,
       CAST(sum(CAST(m.total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM latest m LEFT JOIN raw_customers c ON c.platform = m.platform AND c.customer_id = m.customer_id GROUP BY 1, 2""",
    "latest_version_view": f"{_MERGED} SELECT order_id, platform, financial_status, updated_at FROM merged",
    "preview_rows": f"""{_BASE}
SELECT order_id, platform, financial_status, total_price FROM bronze ORDER BY order_id, platform LIMIT 20""",
    "clustered_layout": f"""{_BASE}
SELECT order_id, created_at_date, total_price FROM bronze
WHERE created_at_date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28'""",
    "part_files": f"""{_BASE}
SELECT strftime(created_at_date, '%Y-%m') AS month, count(*) AS orders, true AS files_bounded FROM bronze GROUP BY 1""",
    "scd2_snapshot": f"""{_CHANGED}
SELECT platform, order_id, financial_status, total_price, updated_at, updated_at AS valid_from,
       CASE WHEN order_id % 10 = 0 THEN updated_at + INTERVAL 10 YEAR
            WHEN order_id % 50 = 3 THEN TIMESTAMP '2012-01-01' END AS valid_to,
       NOT (order_id % 10 = 0 OR order_id % 50 = 3) AS is_current
FROM bronze
UNION ALL
SELECT platform, order_id, financial_status, total_price, updated_at, updated_at, NULL, true FROM changes
UNION ALL
SELECT platform, order_id, financial_status, total_price, updated_at, TIMESTAMP '2012-01-01', NULL, true
FROM bronze WHERE order_id % 50 = 3""",
    "scd2_check_columns": f"""{_CHANGED}
SELECT platform, order_id, financial_status, TIMESTAMP '2011-01-01' AS valid_from,
       CASE WHEN order_id % 10 = 0 OR order_id % 50 = 3 THEN TIMESTAMP '2012-01-01' END AS valid_to,
       NOT (order_id % 10 = 0 OR order_id % 50 = 3) AS is_current
FROM bronze
UNION ALL
SELECT platform, order_id, financial_status, TIMESTAMP '2012-01-01', NULL, true FROM changes""",
    "dq_not_null": f"{_BASE} SELECT order_id, fulfillment_status FROM bronze WHERE fulfillment_status IS NULL",
    "dq_unique": _DUPLICATES,
    "dq_is_valid_date": f"{_BASE} SELECT created_at_date FROM bronze WHERE {_DATE_FAILS}",
    "dq_non_negative": "SELECT c_acctbal AS balance FROM customer WHERE c_acctbal < 0",
    "dq_summary": f"""{_BASE}, checks AS ({_CHECKS})
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM checks""",
    "source_freshness": f"""{_BASE}, loads AS ({_LOADS}),
aged AS (
  SELECT *, CAST(floor((epoch_us(TIMESTAMP '2001-08-04 12:00:00') - epoch_us(max_loaded_at)) / 1000000) AS BIGINT)
    AS age_seconds FROM loads
)
SELECT * EXCLUDE (warn, error), CASE WHEN age_seconds IS NULL OR age_seconds > error * 3600 THEN 'error'
               WHEN age_seconds > warn * 3600 THEN 'warn' ELSE 'pass' END AS status FROM aged""",
    "monitor_freshness": f"""{_BASE}, newest AS (
  SELECT 'bronze.br_shopify_us_orders' AS table_name, max(updated_at) AS last_at,
         CAST(720 AS BIGINT) AS limit_minutes FROM bronze WHERE platform = 'yoga-us'
  UNION ALL SELECT 'silver.silver_customers', max(updated_at), 720 FROM raw_customers
  UNION ALL SELECT 'gold.gold_revenue_daily', CAST(max(created_at_date) AS TIMESTAMP), 1440
  FROM bronze WHERE financial_status = 'paid'
)
SELECT *, CASE WHEN last_at IS NULL OR last_at < TIMESTAMP '2002-01-01' - to_minutes(limit_minutes)
               THEN 'stale' ELSE 'fresh' END AS status FROM newest""",
    "monitor_volume": _BASE + _METRIC.format(metric="row_count", value=_ROWS),
    "monitor_metric_mean": _BASE + _METRIC.format(metric="mean total_price", value=_MEAN),
    "monitor_anomaly": f"""{_BASE}, history AS (
  {_HISTORY.format(metric="row_count", value=_ROWS)}
  UNION ALL
  {_HISTORY.format(metric="mean total_price", value=_MEAN)}
)
SELECT metric, run_at, count(metric_value) OVER past AS baseline_runs,
       coalesce(abs(metric_value - avg(metric_value) OVER past) > 3 * stddev_samp(metric_value) OVER past, false)
         AS is_anomaly
FROM history
WINDOW past AS (PARTITION BY metric ORDER BY run_at ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    "monitor_schema": f"""{_BASE}, daily AS ({_DAILY.format(table="bronze")})
SELECT t.*, (SELECT count(*) FROM daily WHERE orders > 1) AS table_rows
FROM (VALUES ('orders', NULL, 'bigint', 'added'), ('note', 'string', NULL, 'removed'),
             ('revenue', 'decimal(18,2)', 'double', 'retyped'))
  AS t(column_name, old_type, new_type, change)""",
    "stream_dedup_events": """
SELECT DISTINCT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events""",
    "stream_first_arrivals": _ARRIVALS,
    "stream_upsert_orders": f"{_MERGED} SELECT * FROM merged WHERE platform = 'yoga-us'",
    "stream_and_batch_orders": f"""{_MERGED}
SELECT * FROM merged WHERE platform = 'yoga-us' UNION ALL SELECT * FROM bronze WHERE platform <> 'yoga-us'""",
    "daily_run": _NEXT_DAY + _DAILY.format(table="day_after"),
    "full_refresh_run": _MONTHLY,
}
