"""Operators that turn many raw relations into one clean one."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_stores(stores: Mapping[str, str], scan: Callable[[str], DataFrame]) -> DataFrame:
    """All stores' relations as one, tagged with the store's ``platform`` key."""
    tagged = [scan(source).withColumn("platform", F.lit(store)) for store, source in stores.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``, then by the other columns.

    One pass over ``df``. Each task first keeps the last of its own rows of a
    key, so a key with many copies costs one row per task in the shuffle. Rows
    whose key is NULL match nothing: all of them stay, and a number of their
    own spreads them over the tasks.
    """
    return df.sparkSession.sql(latest_sql("{rows}", df.schema, keys, order_by), rows=df)


def latest_sql(relation: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str]) -> str:
    """``latest_per_key`` as SQL over a relation with this schema, for views."""
    rest = [c for c in schema.names if c not in keys and c not in order_by]
    # Maps have no order, so they are carried along but break no tie.
    ordered = [*order_by, *[c for c in rest if not _has_map(schema[c].dataType)]]
    by = [f"`{k}`" for k in keys]
    if any(schema[k].nullable for k in keys):
        known = " AND ".join(f"{k} IS NOT NULL" for k in by)
        relation = f"(SELECT *, CASE WHEN {known} THEN -1 ELSE monotonically_increasing_id() END AS _alone FROM {relation})"
        by.append("_alone")
    last = f"PARTITION BY {', '.join(by)} ORDER BY {', '.join(f'`{c}` DESC' for c in ordered)}"
    columns = ", ".join(f"`{c}`" for c in schema.names)
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER ({last}) AS _nth FROM {relation}) WHERE _nth = 1"


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def high_water(df: DataFrame, column: str) -> Column | None:
    """``max(column)`` read once, as a literal; None if there is no value."""
    kind = df.schema[column].dataType
    top = F.max(column)
    if isinstance(kind, T.TimestampType):
        value = df.agg(F.unix_micros(top)).first()[0]
        return None if value is None else F.timestamp_micros(F.lit(value))
    value = df.agg(top).first()[0]
    return None if value is None else F.lit(value).cast(kind)


def high_water_marks(df: DataFrame, by: str, column: str) -> DataFrame:
    """(``by``, high_water): the greatest value of each group that has one, in one pass."""
    return df.groupBy(by).agg(F.max(column).alias("high_water")).filter("high_water IS NOT NULL")


def changed_rows(
    source: DataFrame, target: DataFrame | None, column: str, lookback: timedelta | None = None
) -> DataFrame:
    """Source rows newer than anything in the target.

    Without a target, or with one that holds no value yet, this is the whole
    source. Rows equal to the mark are skipped unless ``lookback`` widens the
    filter; merging a row a second time changes nothing.
    """
    return rows_after(source, None if target is None else high_water(target, column), column, lookback)


def rows_after(source: DataFrame, mark: Column | None, column: str, lookback: timedelta | None = None) -> DataFrame:
    """``changed_rows`` for a mark that is known already."""
    if mark is None:
        return source
    if lookback is not None:
        mark = mark - F.expr(f"INTERVAL {int(lookback.total_seconds())} SECONDS")
    return source.filter(F.col(column) > mark)


def from_cutoff(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows on or after a cut-off date or time."""
    return df.filter(F.col(column) >= F.lit(cutoff).cast(df.schema[column].dataType))


def join_dimension(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of facts to a dimension that has each key once.

    One plan at any size: Spark broadcasts a dimension below its own limit, and
    splits a hot key's facts at run time when both sides are shuffled.
    """
    return fact.join(dim, list(on), "left")
