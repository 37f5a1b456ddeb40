"""Fixed values of the project: store maps, cut-offs, limits, schedules.

Everything here is plain data. A run may override any cut-off through
``Context.vars``.
"""

from __future__ import annotations

from datetime import timedelta

# --- fixed values: store key -> source name -------------------------------
STORE_SOURCES = {
    "yoga-us": "src_shopify_us",
    "yoga-canada": "src_shopify_can",
    "yoga-uk": "src_shopify_uk",
    "yoga-intl": "src_shopify_intl",
}

STORE_STREAM_SOURCES = {
    "yoga-us": "br_src_shopify_us",
    "yoga-canada": "br_src_shopify_can",
    "yoga-uk": "br_src_shopify_uk",
    "yoga-intl": "br_src_shopify_intl",
}

STORE_RETAIL_SOURCES = {
    "yoga-us": "src_shopify_us_retail_only",
    "yoga-canada": "src_shopify_can",
    "yoga-uk": "src_shopify_uk",
    "yoga-us-2": "src_shopify_us",
    "yoga-intl": "src_shopify_intl",
}

# --- fixed values: store key -> currency / short code ---------------------
STORE_CURRENCY = {
    "yoga-us": "USD",
    "yoga-canada": "CAD",
    "yoga-uk": "GBP",
    "yoga-intl": "EUR",
    "yoga-nl": "EUR",
    "yoga-kor": "KRW",
    "yoga-ita": "EUR",
}

STORE_CODE = {"yoga-us": "US", "yoga-canada": "CA", "yoga-uk": "UK", "yoga-intl": "INTL"}

# --- fixed values: cut-off dates, some of them per environment ------------
CUTOFFS = {
    "retention_date": "2022-12-30",
    "graphql_cut_off_datetime": {"dev": "2025-02-10T00:00:00", "other": "2025-02-25T00:00:00"},
    "sts_cutoff_date": "2025-10-06",
    "preorder_cutoff_date": {"dev": "2026-02-16", "other": "2026-02-24"},
    "shopify_product_variant_active_list_cutoff_date": "2026-01-13",
}

# The canonical name of the zone whose alias the project gives.
REPORTING_TIME_ZONE = "America/Los_Angeles"

# --- fixed values: source freshness limits --------------------------------
HOURS_LIMITS = (timedelta(hours=12), timedelta(hours=24))
DAYS_LIMITS = (timedelta(days=1), timedelta(days=2))

# --- fixed values: the oldest valid date and the look-ahead ----------------
FIRST_VALID_DATE = "2000-01-01"
VALID_DAYS_AHEAD = 365

# --- fixed values: monitored tables ----------------------------------------
# (monitor, kind, table, watched column, minutes between runs)
MONITORS = (
    ("br_shopify_us_orders_freshness", "freshness", "bronze.br_shopify_us_orders", "updated_at", 720),
    ("br_shopify_us_orders_volume", "volume", "bronze.br_shopify_us_orders", None, 720),
    ("silver_customers_freshness", "freshness", "silver.silver_customers", "updated_at", 720),
    ("gold_revenue_daily_freshness", "freshness", "gold.gold_revenue_daily", "created_at_date", 1440),
    ("gold_revenue_daily_schema", "schema", "gold.gold_revenue_daily", None, None),
    ("br_shopify_us_orders_revenue_anomaly", "mean", "bronze.br_shopify_us_orders", "total_price", 1440),
)

# Our choice: past runs in the anomaly baseline, and the allowed deviations.
ANOMALY_RUNS = 14
ANOMALY_SIGMAS = 3.0

# Our choice: buckets by key of each date unit of a table that takes small changes all the
# time. ``Context.buckets`` says otherwise for a table; choose as many as keep a bucket small.
KEY_BUCKETS = 4

# --- fixed values: shuffle partitions by kind of run -----------------------
SHUFFLE_PARTITIONS = {"daily": 200, "full_refresh": 400}


def cutoff(name: str, env: str, overrides: dict | None = None) -> str:
    """The cut-off called ``name`` in ``env``; a run's override wins."""
    if overrides and name in overrides:
        return overrides[name]
    value = CUTOFFS[name]
    if isinstance(value, dict):
        return value["dev" if env == "dev" else "other"]
    return value
