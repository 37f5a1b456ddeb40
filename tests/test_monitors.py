from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers import settings
from lakelayers.operators import monitors

NOW = datetime(2024, 6, 1, 12)


def at(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp") if moment else F.lit(None).cast("timestamp")


@pytest.mark.parametrize("hours, status", [
    (0, "pass"), (12, "pass"), (18, "warn"), (24, "warn"), (25, "error"), (None, "error"), (-3, "pass"),
])
def test_freshness_ages(spark, hours, status):
    last = None if hours is None else NOW - timedelta(hours=hours)
    loaded = spark.range(1).select(F.lit("s").alias("source"), F.lit("t").alias("table_name"), at(last).alias("max_loaded_at"))
    r = monitors.source_freshness(loaded, at(NOW), *settings.HOURS_LIMITS).first()
    assert r.status == status
    assert r.age_seconds == (None if hours is None else hours * 3600)


def test_a_microsecond_over_the_limit(spark):
    last = NOW - timedelta(hours=12, microseconds=1)
    got = spark.range(1).select(monitors.freshness_status(at(last), at(NOW), *settings.HOURS_LIMITS).alias("s")).first()
    assert got.s == "warn"


def test_table_freshness(spark):
    df = spark.range(1).select(at(NOW - timedelta(minutes=720)).alias("t"))
    assert monitors.table_freshness(df, "x", "t", 720, at(NOW)).first().status == "fresh"
    assert monitors.table_freshness(df, "x", "t", 719, at(NOW)).first().status == "stale"
    assert monitors.table_freshness(df.limit(0), "x", "t", 720, at(NOW)).first().status == "stale"


def test_metrics(spark):
    df = spark.createDataFrame([(1.1,), (2.2,), (None,)], "v double")
    assert monitors.volume(df, "t", at(NOW)).first()[:] == ("t", "row_count", NOW, 3.0)
    assert monitors.mean(df, "t", "v", at(NOW)).first()[:] == ("t", "mean v", NOW, 1.65)


def history(spark, values, metric="m"):
    start = datetime(2024, 1, 1)
    data = [("t", metric, start + timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "table_name string, metric string, run_at timestamp, metric_value double")


def test_anomaly(spark):
    df = history(spark, [10, 11, 9, 10, 11, 9, 30, 10]).unionByName(history(spark, [30] * 8, "other"))
    out = monitors.flag_anomalies(df)
    assert rows(out.filter("is_anomaly"), "metric", "metric_value", "baseline_runs") == [("m", 30.0, 6)]


def test_anomaly_needs_two_runs_and_forgets_old_ones(spark):
    out = monitors.flag_anomalies(history(spark, [1, 100] + [5] * 20 + [6]), runs=3)
    assert [r.baseline_runs for r in out.orderBy("run_at").collect()] == [0, 1, 2] + [3] * 20
    assert rows(out.filter("is_anomaly"), "metric_value") == [(6.0,)]


def test_schema_changes(spark):
    old, new = spark.sql("SELECT 1 AS a, 'x' AS b, 1.5D AS c").schema, spark.sql("SELECT 1L AS a, 1.5D AS c, 2 AS d").schema
    assert rows(monitors.schema_changes(spark, old, new)) == [
        ("a", "int", "bigint", "retyped"), ("b", "string", None, "removed"), ("d", None, "int", "added"),
    ]
    assert monitors.schema_changes(spark, old, old).count() == 0


def test_declared_monitors():
    kinds = [m[1] for m in settings.MONITORS]
    assert sorted(kinds) == ["freshness", "freshness", "freshness", "mean", "schema", "volume"]
