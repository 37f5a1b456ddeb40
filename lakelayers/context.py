"""What one run knows: session, where to read, where to write, and the time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers import session, settings
from lakelayers.operators.publish import Layout, TableStore


@dataclass
class Context:
    """``sources`` and ``tables`` are separate roots, so a development run can
    read production data and write to its own tables."""

    spark: SparkSession
    sources: Any
    tables: TableStore | None = None
    env: str = "dev"
    run_at: datetime | None = None
    vars: dict[str, str] = field(default_factory=dict)
    materialization: str = "view"
    """How models that do not say so are kept."""
    seeds: dict[str, str] = field(default_factory=dict)
    """Path of each seed's CSV."""
    buckets: dict[str, int] = field(default_factory=dict)
    """Buckets by key of tables whose layout has keys, where not as many as their models say."""

    def __post_init__(self) -> None:
        session.pin(self.spark)
        if self.run_at is None:
            self.run_at = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)

    def source(self, name: str, table: str) -> DataFrame:
        return self.sources.scan(name, table)

    def ref(self, name: str) -> DataFrame:
        """The current version of a published table, or a view model of the catalog."""
        if self.tables.version(name) is None and self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        return self.tables.read(name)

    def layout(self, name: str, layout: Layout) -> Layout:
        """The layout of a table in this run."""
        return replace(layout, buckets=self.buckets.get(name, layout.buckets)) if layout.keys else layout

    def table(self, name: str) -> DataFrame:
        """Any table or view of the session's catalog."""
        return self.spark.table(name)

    def preview(self, name: str, rows: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
        """Some rows of a table or view, to look at; the first ones of an order, if given."""
        found = self.table(name)
        return (found.orderBy(*order_by) if order_by else found).limit(rows)

    def cutoff(self, name: str) -> str:
        return settings.cutoff(name, self.env, self.vars)

    @property
    def now(self) -> Column:
        """The run's time as a column, in place of the clock."""
        return F.lit(self.run_at.isoformat(sep=" ")).cast("timestamp")
