"""Data tests. Each gives the failing rows; none means the test passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers import settings
from lakelayers.operators.merge import duplicate_keys
from lakelayers.operators.publish import TableStore


class QualityError(AssertionError):
    """At least one data test failed."""


def is_invalid_date(column: str, today: Column) -> Column:
    """Before the first valid date, or more than a year ahead of ``today``."""
    value = F.col(column)
    first = F.lit(settings.FIRST_VALID_DATE).cast("date")
    return (value < first) | (value > F.date_add(today.cast("date"), settings.VALID_DAYS_AHEAD))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return duplicate_keys(df, columns)


def is_valid_date(df: DataFrame, column: str, today: Column) -> DataFrame:
    return df.filter(is_invalid_date(column, today)).select(column)


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0).select(column)


@dataclass(frozen=True)
class Check:
    """One data test bound to columns of one table."""

    table: str
    test: str
    columns: tuple[str, ...]


def run_checks(
    spark: SparkSession, frames: dict[str, DataFrame], checks: Sequence[Check], today: Column
) -> DataFrame:
    """``(table_name, column_name, test, failures, status)`` for every check.

    All row-level checks of a table are counted in one scan of it; each
    uniqueness check needs a grouping of its own.
    """
    results = []
    for table, df in frames.items():
        mine = [c for c in checks if c.table == table]
        rowwise = [c for c in mine if c.test != "unique"]
        if rowwise:
            counts = df.agg(*[F.count_if(_fails(c, today)).alias(f"n{i}") for i, c in enumerate(rowwise)])
            lines = [_line(c, F.col(f"n{i}")) for i, c in enumerate(rowwise)]
            results.append(counts.select(F.inline(F.array(*lines))))
        for c in mine:
            if c.test == "unique":
                n = duplicate_keys(df, c.columns).agg(F.count("*").alias("n"))
                results.append(n.select(F.inline(F.array(_line(c, F.col("n"))))))
    unknown = {c.table for c in checks} - set(frames)
    if unknown:
        raise LookupError(f"checks on unknown tables: {sorted(unknown)}")
    return reduce(DataFrame.unionByName, results)


def row_tests(checks: Sequence[Check]) -> dict[str, Column]:
    """What makes a row fail each of the checks, for counting while rows are written."""
    return {recorded_as(c): _fails(c, F.current_date()) for c in checks if c.test in TIMELESS}


def recorded_as(check: Check) -> str:
    return f"{check.test} {', '.join(check.columns)}"


def run_recorded(tables: TableStore, checks: Sequence[Check], today: Column) -> DataFrame:
    """``run_checks`` over published tables, of which only what has to be read is.

    Where a version says which of its parts hold rows that fail a check, only
    those are read, to count the rows; if there are none, nothing is.
    """
    results, open_ = [], []
    for check in checks:
        v = tables.version(check.table)
        if v is None:
            raise LookupError(f"checks on unknown tables: {[check.table]}")
        failing = v.failing.get(recorded_as(check))
        if failing is None:
            open_.append(check)
        elif failing:
            results.append(run_checks(tables.spark, {check.table: tables.read_version(check.table, v, failing)}, [check], today))
        else:
            results.append(tables.spark.range(1).select(F.inline(F.array(_line(check, F.lit(0).cast("bigint"))))))
    frames = {c.table: tables.read(c.table) for c in open_}
    if frames:
        results.append(run_checks(tables.spark, frames, open_, today))
    return reduce(DataFrame.unionByName, results)


def require_passing(results: DataFrame) -> list:
    """The outcome of each check; raises if any failed."""
    rows = results.collect()  # one row per check
    failed = [r for r in rows if r["status"] != "pass"]
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed))
    return rows


# Checks whose outcome for a row does not depend on when it is asked.
TIMELESS = ("not_null", "non_negative")


def _fails(check: Check, today: Column) -> Column:
    (column,) = check.columns
    if check.test == "not_null":
        return F.col(column).isNull()
    if check.test == "is_valid_date":
        return is_invalid_date(column, today)
    if check.test == "non_negative":
        return F.col(column) < 0
    raise ValueError(f"unknown data test {check.test}")


def _line(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(", ".join(check.columns)).alias("column_name"),
        F.lit(check.test).alias("test"),
        failures.alias("failures"),
        F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )
