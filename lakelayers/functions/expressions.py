"""Column expressions shared by the models. Each returns a ``Column``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayers import settings

MONEY = "decimal(18,2)"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def cents_to_dollars(column: Column | str, scale: int = 2, divisor: float = 100.0) -> Column:
    """Minor units to major units as a double, rounded half up."""
    return F.round(_col(column).cast("double") / F.lit(divisor), scale)


def price_with_tax(column: Column | str, factor: float = 1.1, scale: int = 2) -> Column:
    return F.round(_col(column) * F.lit(factor), scale)


def case_map(column: Column | str, mapping: Mapping[str, str], other: str | None = "other") -> Column:
    """CASE over equality with each key; NULL and unknown values give ``other``."""
    value = _col(column).cast("string")
    if not mapping:
        return F.lit(other).cast("string")
    branches = [(value == F.lit(k), F.lit(v)) for k, v in mapping.items()]
    first, *rest = branches
    chain = reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))
    return chain.otherwise(F.lit(other))


def store_currency(platform: Column | str) -> Column:
    """Currency of a store; NULL for a store without one."""
    return case_map(platform, settings.STORE_CURRENCY, None)


def store_code(platform: Column | str) -> Column:
    """Short code of a store; NULL for a store without one."""
    return case_map(platform, settings.STORE_CODE, None)


def local_time(column: Column | str, zone: str = settings.REPORTING_TIME_ZONE) -> Column:
    """Wall-clock time in the reporting zone of a UTC timestamp."""
    return F.from_utc_timestamp(_col(column), zone)


def local_date(column: Column | str, zone: str = settings.REPORTING_TIME_ZONE) -> Column:
    return F.to_date(local_time(column, zone))


def money_sum(column: Column | str) -> Column:
    """Exact sum of a money column, as a double.

    A double sum depends on the order in which tasks finish; a decimal one
    does not.
    """
    return F.sum(_col(column).cast(MONEY)).cast("double")


def money_mean(column: Column | str) -> Column:
    value = _col(column)
    return F.try_divide(money_sum(value), F.count(value))


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)
