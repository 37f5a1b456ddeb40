"""Models: a named DataFrame and how it is kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame

from lakelayers.context import Context
from lakelayers.operators.conform import changed_rows, rows_after
from lakelayers.operators.merge import merge
from lakelayers.operators.publish import Layout, as_view
from lakelayers.operators.quality import Check, row_tests

KINDS = ("view", "table", "incremental")


@dataclass(frozen=True)
class Model:
    """``build`` gives the model's rows, or, for a view, its SQL text.

    A ``view`` is a catalog view over other published tables and views, planned
    anew by each reader. A ``table`` is rebuilt by each run, unless all its
    ``inputs`` are as they were. An ``incremental`` table takes in the rows
    whose ``changed_on`` is newer than anything it holds, and of each key the
    newer row stays. ``None`` leaves the kind to the context.

    ``layout`` splits the table; its buckets are the run's to choose.
    """

    name: str
    build: Callable[[Context], DataFrame | str]
    materialized: str | None = None
    unique_key: tuple[str, ...] = ()
    layout: Layout = Layout()
    changed_on: str | None = None
    lookback: timedelta | None = None
    inputs: tuple[str, ...] = ()
    tests: tuple[Check, ...] = ()
    """Tests of single rows that are counted while they are written."""

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    def kind(self, ctx: Context) -> str:
        kind = self.materialized or ctx.materialization
        if kind not in KINDS:
            raise ValueError(f"model {self.name}: unknown materialization {kind}")
        if kind == "incremental" and not (self.unique_key and self.changed_on):
            raise ValueError(f"model {self.name}: incremental needs unique_key and changed_on")
        return kind


@dataclass(frozen=True)
class Outcome:
    layer: str
    name: str
    version: int | None
    """None for a view."""


def run_model(ctx: Context, model: Model, full_refresh: bool = False) -> Outcome:
    """Bring one model up to date. ``full_refresh`` ignores what is stored."""
    kind = model.kind(ctx)
    if kind == "view":
        sql = model.build(ctx)
        if not isinstance(sql, str):
            raise ValueError(f"model {model.name}: a view is defined by SQL text")
        as_view(ctx.spark, model.name, sql)
        return Outcome(model.layer, model.name, None)
    old = ctx.tables.version(model.name)
    sources = {name: ctx.tables.version(name) for name in model.inputs}
    if kind == "table" and model.inputs and old is not None and not full_refresh and not old.stale_parts(sources):
        return Outcome(model.layer, model.name, old.number)
    tests = row_tests(model.tests)
    rows = model.build(ctx)
    if isinstance(rows, str):
        rows = ctx.spark.sql(rows)
    if kind == "table" or full_refresh or old is None:
        new = ctx.tables.replace(model.name, rows, ctx.layout(model.name, model.layout), sources=sources, tests=tests)
    else:
        if old.layout.mark == model.changed_on:
            changes = rows_after(rows, ctx.tables.newest(model.name, old), model.changed_on, model.lookback)
        else:
            changes = changed_rows(rows, ctx.tables.read_version(model.name, old), model.changed_on, model.lookback)
        new = merge(ctx.tables, model.name, changes, model.unique_key, newer_by=model.changed_on, tests=tests).version
    return Outcome(model.layer, model.name, new.number)
