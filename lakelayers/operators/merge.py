"""Upsert by key into a published table: update matches, insert the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.publish import Layout, TableStore, Tests, Version


RANGED = (T.IntegralType, T.StringType, T.DateType)


class DuplicateKeyError(ValueError):
    """A change set names one key twice, so the outcome would be arbitrary."""


@dataclass(frozen=True)
class MergeResult:
    version: Version
    touched: list[str]
    """Parts whose rows differ from the version before."""


def known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found more than once, with their count. NULL keys do not count."""
    return df.filter(known(keys)).groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def key_range(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """A filter that holds for every row whose key is in ``df``.

    New keys tend to lie close together, so with it a scan of a big table
    skips most row groups by their statistics.
    """
    ranged = [k for k in keys if isinstance(df.schema[k].dataType, RANGED)]
    if not ranged:
        return None
    ends = df.filter(known(keys)).agg(*[f(k) for k in ranged for f in (F.min, F.max)]).first()
    if ends[0] is None:
        return None
    return reduce(lambda a, b: a & b, [F.col(k).between(*ends[2 * i : 2 * i + 2]) for i, k in enumerate(ranged)])


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    bad = duplicate_keys(df, keys).select(*keys).take(1)
    if bad:
        raise DuplicateKeyError(f"{what} holds key {bad[0].asDict()} more than once")


def fit_columns(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """The table's columns in its order and types; others are left out."""
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not in ``other``, in one pass over both.

    Rows without a key match nothing. A hash of their other columns joins the
    key, so they do not all meet in one task.
    """
    hashed = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
    left = df.withColumn("_alone", F.when(known(keys), F.lit(0)).otherwise(F.xxhash64(*hashed)))
    right = other.filter(known(keys)).select(*keys, F.lit(0).cast("bigint").alias("_alone"))
    return left.join(right, [*keys, "_alone"], "left_anti").select(*df.columns)


def merge(
    tables: TableStore,
    name: str,
    changes: DataFrame,
    keys: Sequence[str],
    layout: Layout | None = None,
    newer_by: str | None = None,
    tag: tuple[str, int] | None = None,
    insert_only: bool = False,
    tests: Tests | None = None,
) -> MergeResult:
    """Publish ``name`` with ``changes`` merged in.

    ``changes`` must hold each key once. NULL keys match nothing: such rows of
    both sides stay. With ``newer_by``, a change that is older than the stored
    row is left out; with ``insert_only``, so is any whose key is stored.
    ``tag`` names a stream and its batch; a batch at or below the recorded one
    is skipped, so replaying it does nothing.

    A part that holds a matched row or gets a new one is rewritten, so a part is
    always one folder. Other parts are carried over by name. In a table that is
    split by a hash of its keys, or of some of them, only the buckets of the
    changed keys are read at all. ``tests`` are counted on what is written.
    """
    keys = list(keys)
    old = tables.version(name)
    if old is not None and tag is not None and old.tags.get(tag[0], -1) >= tag[1]:
        return MergeResult(old, [])
    tags = {**(old.tags if old else {}), **(dict([tag]) if tag else {})}

    # The changes are written down once: the steps below read them several
    # times, and the table they came from may move on meanwhile.
    with tables.staging() as stage:
        if old is None or not old.parts:
            first = stage(fit_columns(changes, old.schema, "the change set") if old else changes)
            require_unique(first, keys, f"the first load of {name}")
            if old is not None and tag is None and first.isEmpty():
                return MergeResult(old, [])
            v = tables.replace(name, first, layout or (old.layout if old else None), tags, tests=tests)
            return MergeResult(v, sorted(v.parts))

        fresh = stage(fit_columns(changes, old.schema, "the change set"))
        near = key_range(fresh, keys)
        require_unique(fresh, keys, f"the change set for {name}")
        stored_rows = tables.read_version(name, old, _reached(old, fresh, keys), with_part=True)
        target = stored_rows if near is None else stored_rows.filter(near)
        if insert_only:
            hit, fresh = None, stage(without_keys(fresh, target, keys))
        elif newer_by is None:
            hit = matched(target, fresh, keys, near)
        else:
            stored = target.select(*keys, "_part", F.col(newer_by).alias("_stored"))
            late = F.coalesce(F.col(newer_by) < F.col("_stored"), F.lit(False))
            found = stored.join(fresh.select(*keys, newer_by), keys).withColumn("_late", late)
            found = stage(found.select(*keys, "_part", "_late"))
            fresh = stage(without_keys(fresh, found.filter("_late"), keys))
            hit = found.filter(~F.col("_late"))
        parts_of = fresh.select(old.layout.part().alias("_part"))
        # One row per part, of which there are as many as dates at most.
        touched = parts_of if hit is None else parts_of.unionByName(hit.select("_part"))
        touched = sorted(r[0] for r in touched.distinct().collect())
        if not touched:
            if tag is None:
                return MergeResult(old, [])
            return MergeResult(tables.commit(name, replace(old, number=old.number + 1, tags=tags)), [])

        before = stored_rows.filter(F.col("_part").isin(touched)).select(*old.schema.names)
        rows = without_keys(before, fresh, keys).unionByName(fresh)
        new, failing = tables.write_rows(name, rows.select(*old.schema.names), old.layout, tests=tests)

    parts = {p: w for p, w in old.parts.items() if p not in touched}
    return MergeResult(tables.commit(name, old.after({**parts, **new}, new, failing, tags=tags)), touched)


def matched(target: DataFrame, fresh: DataFrame, keys: Sequence[str], near: Column | None) -> DataFrame:
    """(keys, _part) of the rows of ``target`` whose key is in ``fresh``.

    The range of the keys holds for both sides. To Spark it is what makes the
    changes a choice few rows pass, so where they are too many to broadcast it
    filters the big side by a Bloom filter of their keys before the shuffle:
    what the range cannot skip, because changed keys lie anywhere, that does.
    """
    wanted = fresh.select(*keys) if near is None else fresh.select(*keys).filter(near)
    return target.select(*keys, "_part").join(wanted, list(keys), "left_semi")


def _reached(old: Version, fresh: DataFrame, keys: Sequence[str]) -> list[str] | None:
    """The parts that rows with the keys of ``fresh`` can be in; None if in any."""
    if old.layout.buckets == 1 or not set(old.layout.keys) <= set(keys):
        return None
    # No more rows than there are buckets.
    return old.layout.holding(old.parts, [r[0] for r in fresh.select(old.layout.bucket().alias("b")).distinct().collect()])
