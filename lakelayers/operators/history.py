"""History tables: one row per key and period of validity (SCD type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.merge import fit_columns, known, require_unique
from lakelayers.operators.publish import Layout, TableStore, Version

# Columns of the log beside the source's: from when a row holds, whether it says
# that its key is gone, and the run that wrote it.
LOG = T.StructType([
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("_gone", T.BooleanType()),
    T.StructField("_run", T.LongType()),
])


def snapshot(
    tables: TableStore,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    run_at: Column,
    updated_at: str | None = None,
    check: Sequence[str] | None = None,
) -> Version:
    """Record what ``source`` looks like now in the history table ``name``.

    A row has changed when its ``updated_at`` is later than the open row's, or,
    with ``check``, when any of those columns differs. The old row closes where
    the new one opens; a key missing from the source closes at ``run_at``; a
    key that comes back opens a new row, no earlier than its last one closed.
    So periods of a key never overlap, and none ends before it starts.

    What is stored is a log: a run appends one row for each key that changed,
    came or went, and writes nothing else. A reader gets periods: a row ends
    where the next one of its key begins (``periods_sql``). A run compares the
    source with the last row of each key, of which it reads the key, times and
    compared columns only. Without a change nothing is published.
    """
    if (updated_at is None) == (check is None):
        raise ValueError("give either updated_at or check")
    keys = list(keys)
    starts = F.col(updated_at).cast("timestamp") if updated_at else run_at
    compared = [updated_at] if updated_at else list(check)

    old = tables.version(name)
    number = old.number + 1 if old else 1
    with tables.staging() as stage:
        if old is not None:
            source = fit_columns(source, T.StructType([f for f in old.schema.fields if f.name not in LOG.names]), "the snapshot source")
        new = stage(source.withColumn("_starts", starts))
        columns = [c for c in new.columns if c != "_starts"]
        _require_keys(new, keys, name)
        if old is None:
            rows = new.select(*columns, F.col("_starts").alias("valid_from"), F.lit(False).alias("_gone"), F.lit(number).cast("long").alias("_run"))
        else:
            last = _last(tables.read_version(name, old), keys, compared)
            rows = stage(_outcome(last, new, keys, columns, run_at, compared, updated_at is not None, number))
            if rows.isEmpty():
                return old
        part = f"run-{number:08d}"
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        written, _ = tables.write_rows(name, rows, Layout(), F.lit(part))

    parts = {**(old.parts if old else {}), **written}
    return tables.commit(name, Version(number, schema, Layout(), parts, reading=periods_sql(columns, keys)))


def periods_sql(columns: Sequence[str], keys: Sequence[str]) -> str:
    """The log as periods, as SQL over ``{rows}``, for tables and catalog views alike.

    A key has as many rows as it had changes, so no window is large.
    """
    told = ", ".join(f"`{c}`" for c in columns)
    by = ", ".join(f"`{k}`" for k in keys)
    return (
        f"SELECT {told}, valid_from, valid_to, valid_to IS NULL AS is_current FROM (SELECT *, lead(valid_from) OVER "
        f"(PARTITION BY {by} ORDER BY valid_from, _run) AS valid_to FROM {{rows}}) WHERE NOT _gone"
    )


def _require_keys(df: DataFrame, keys: list[str], name: str) -> None:
    if df.filter(~known(keys)).take(1):
        raise ValueError(f"the snapshot source of {name} has rows without a key")
    require_unique(df, keys, f"the snapshot source of {name}")


def _last(log: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """(keys, was) of the last row of each key, with what it is compared by."""
    told = F.struct("_run", "valid_from", "_gone", *[F.col(c).alias(f"c{i}") for i, c in enumerate(compared)])
    return log.groupBy(*keys).agg(F.max_by(told, "_run").alias("was"))


def _outcome(
    last: DataFrame, new: DataFrame, keys: list[str], columns: list[str], run_at: Column, compared: list[str], by_time: bool, number: int
) -> DataFrame:
    """The rows that a run adds to the log."""
    now = new.select(*keys, F.struct(*columns).alias("now"), F.col("_starts").alias("starts"))
    # Keys are unique and never NULL on both sides, so no key can be hot.
    both = last.join(now, keys, "full_outer")
    here, there = F.col("now").isNotNull(), F.coalesce(~F.col("was._gone"), F.lit(False))
    if by_time:
        differs = F.coalesce(F.col(f"now.{compared[0]}") > F.col("was.c0"), F.lit(False))
    else:
        differs = reduce(lambda a, b: a | b, [~F.col(f"now.{c}").eqNullSafe(F.col(f"was.c{i}")) for i, c in enumerate(compared)])
    changed = both.filter(F.when(here & there, differs).otherwise(here | there))
    key = {k: F.col(k) for k in keys}
    return changed.select(
        *[key.get(c, F.col(f"now.{c}")).alias(c) for c in columns],
        F.greatest(F.when(F.col("now").isNotNull(), F.col("starts")).otherwise(run_at), "was.valid_from").cast("timestamp").alias("valid_from"),
        F.col("now").isNull().alias("_gone"),
        F.lit(number).cast("long").alias("_run"),
    )
