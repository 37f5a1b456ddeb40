"""The declared sources: their tables, load-time column and freshness limits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelayers import session, settings
from lakelayers.operators import conform


@dataclass(frozen=True)
class Source:
    name: str
    tables: tuple[str, ...]
    loaded_at: str | None = None
    limits: tuple[timedelta, timedelta] | None = None
    streaming: bool = False


# --- fixed values: declared sources, their tables and load-time columns ---------
_STORE_TABLES = ("orders", "customers", "order_line", "products", "product_variant")
_US_TABLES = (*_STORE_TABLES, "refund", "order_adjustment", "fulfillment")
_MESSAGES = (
    "users_messages_email_send",
    "users_messages_email_open",
    "users_messages_email_click",
    "users_messages_push_send",
)
_CRM_TABLES = ("account", "contact", "opportunity", "lead")

_DECLARED = (
    Source("src_shopify_us", _US_TABLES, "_fivetran_synced", settings.HOURS_LIMITS),
    Source("src_shopify_can", _STORE_TABLES, "_fivetran_synced", settings.HOURS_LIMITS),
    Source("src_shopify_uk", _STORE_TABLES, "_fivetran_synced", settings.HOURS_LIMITS),
    Source("src_shopify_intl", _STORE_TABLES, "_fivetran_synced", settings.HOURS_LIMITS),
    Source("src_ga4", ("events",), "event_timestamp", settings.HOURS_LIMITS),
    Source("src_braze", _MESSAGES, "time", settings.HOURS_LIMITS),
    Source("src_salesforce", _CRM_TABLES, "_fivetran_synced", settings.DAYS_LIMITS),
    Source("br_src_shopify_us", ("orders", "customers"), streaming=True),
    Source("br_src_shopify_can", ("orders", "customers"), streaming=True),
    Source("br_src_shopify_uk", ("orders", "customers"), streaming=True),
    Source("br_src_shopify_intl", ("orders", "customers"), streaming=True),
)

SOURCES = {s.name: s for s in _DECLARED}


def require(source: str, table: str) -> Source:
    """The declared source, or an error naming what is not declared."""
    if source not in SOURCES:
        raise LookupError(f"source {source} is not declared")
    if table not in SOURCES[source].tables:
        raise LookupError(f"source {source} declares no table {table}")
    return SOURCES[source]


def declared_stores(stores: dict[str, str]) -> dict[str, str]:
    """The entries of a store map whose source is declared."""
    return {store: source for store, source in stores.items() if source in SOURCES}


class ParquetSources:
    """Raw tables as Parquet folders ``<root>/<source>/<table>``."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[tuple[str, str], T.StructType] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas or {}

    def path(self, source: str, table: str) -> str:
        require(source, table)
        return f"{self.root}/{source}/{table}"

    def has(self, source: str, table: str) -> bool:
        return session.exists(self.spark, self.path(source, table))

    def scan(self, source: str, table: str) -> DataFrame:
        reader = self.spark.read
        if (source, table) in self.schemas:
            reader = reader.schema(self.schemas[source, table])
        return reader.parquet(self.path(source, table))

    def scan_stores(self, table: str, stores: dict[str, str] = settings.STORE_SOURCES) -> DataFrame:
        """A table of all stores whose source is declared, tagged with ``platform``."""
        return conform.union_stores(declared_stores(stores), lambda source: self.scan(source, table))

    def stream(self, source: str, table: str, max_files: int | None = None) -> DataFrame:
        """New files of a raw table as a stream; needs its schema."""
        reader = self.spark.readStream.schema(self.schemas[source, table])
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(source, table))
