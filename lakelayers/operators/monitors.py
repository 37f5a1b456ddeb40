"""Monitors: freshness, volume, mean, schema change and anomaly."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers import settings
from lakelayers.functions.expressions import micros_between, money_mean


def _micros(limit: timedelta) -> int:
    return limit // timedelta(microseconds=1)


def freshness_status(last: Column, now: Column, warn: timedelta, error: timedelta) -> Column:
    """Older than a limit counts, being exactly that old does not; nothing
    loaded at all is an error."""
    age = micros_between(last, now)
    return (
        F.when(last.isNull(), F.lit("error"))
        .when(age > F.lit(_micros(error)), F.lit("error"))
        .when(age > F.lit(_micros(warn)), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )


def source_freshness(
    loaded: DataFrame, now: Column, warn: timedelta, error: timedelta
) -> DataFrame:
    """Status of each source table, from rows of ``(source, table_name, max_loaded_at)``."""
    last = F.col("max_loaded_at")
    return loaded.select(
        "source",
        "table_name",
        "max_loaded_at",
        F.floor(micros_between(last, now) / F.lit(1_000_000)).cast("bigint").alias("age_seconds"),
        freshness_status(last, now, warn, error).alias("status"),
    )


def table_freshness(df: DataFrame, table: str, column: str, minutes: int, now: Column) -> DataFrame:
    """Whether a table's newest row is within the monitor's interval."""
    return freshness_line(df.agg(F.max(column).cast("timestamp").alias("last_at")), table, minutes, now)


def freshness_line(newest: DataFrame, table: str, minutes: int, now: Column) -> DataFrame:
    """``table_freshness`` from the one row ``last_at`` of a table."""
    last = F.col("last_at")
    late = last.isNull() | (micros_between(last, now) > F.lit(_micros(timedelta(minutes=minutes))))
    return newest.select(
        F.lit(table).alias("table_name"),
        "last_at",
        F.lit(minutes).cast("bigint").alias("limit_minutes"),
        F.when(late, F.lit("stale")).otherwise(F.lit("fresh")).alias("status"),
    )


def volume(df: DataFrame, table: str, run_at: Column) -> DataFrame:
    """One line of metric history: the row count at this run."""
    return _metric(df, table, "row_count", run_at, F.count("*").cast("double"))


def mean(df: DataFrame, table: str, column: str, run_at: Column) -> DataFrame:
    """One line of metric history: the mean of a money column at this run."""
    return _metric(df, table, f"mean {column}", run_at, money_mean(column))


def _metric(df: DataFrame, table: str, metric: str, run_at: Column, value: Column) -> DataFrame:
    return df.agg(value.alias("metric_value")).select(
        F.lit(table).alias("table_name"),
        F.lit(metric).alias("metric"),
        run_at.cast("timestamp").alias("run_at"),
        "metric_value",
    )


def flag_anomalies(
    history: DataFrame, runs: int = settings.ANOMALY_RUNS, sigmas: float = settings.ANOMALY_SIGMAS
) -> DataFrame:
    """Metric history with ``baseline_runs`` and ``is_anomaly``.

    A value is an anomaly when it is more than ``sigmas`` sample deviations
    from the mean of the ``runs`` values before it. History has one row per
    table, metric and run, so a window holds as many rows as there were runs.
    """
    past = W.partitionBy("table_name", "metric").orderBy("run_at").rowsBetween(-runs, -1)
    off = F.abs(F.col("metric_value") - F.avg("metric_value").over(past))
    limit = F.stddev_samp("metric_value").over(past) * F.lit(sigmas)
    return history.select(
        "*",
        F.count("metric_value").over(past).alias("baseline_runs"),
        F.coalesce(off > limit, F.lit(False)).alias("is_anomaly"),
    )


def schema_changes(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """``(column_name, old_type, new_type, change)`` between two recorded schemas."""
    was = {f.name: f.dataType.simpleString() for f in old.fields}
    now = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [(c, None, now[c], "added") for c in now if c not in was]
    rows += [(c, was[c], None, "removed") for c in was if c not in now]
    rows += [(c, was[c], now[c], "retyped") for c in was if c in now and was[c] != now[c]]
    return spark.createDataFrame(rows, "column_name string, old_type string, new_type string, change string")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
