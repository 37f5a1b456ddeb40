import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers.operators import quality
from lakelayers.operators.quality import Check

def today():
    return F.lit("2024-06-01").cast("date")


def test_not_null_and_non_negative(spark):
    df = spark.createDataFrame([(1, -0.5), (2, 0.0), (None, None)], "id int, v double")
    assert rows(quality.not_null(df, "id")) == [(None, None)]
    assert rows(quality.non_negative(df, "v")) == [(-0.5,)]


def test_unique_counts_keys_but_not_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(quality.unique(df, "id")) == [(1, 2)]


def test_valid_date_bounds(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('old', date'1999-12-31'), ('first', date'2000-01-01'), "
        "('last', date_add(date'2024-06-01', 365)), ('late', date_add(date'2024-06-01', 366)), ('none', NULL) AS t(n, d)"
    )
    assert rows(df.filter(quality.is_invalid_date("d", today())), "n") == [("late",), ("old",)]
    assert quality.is_valid_date(df, "d", today()).columns == ["d"]


@pytest.fixture
def frames(spark):
    a = spark.createDataFrame([(1, -1.0), (1, 2.0), (None, 3.0)], "id int, v double")
    return {"a": a, "b": spark.range(3).toDF("id")}


CHECKS = [
    Check("a", "not_null", ("id",)),
    Check("a", "non_negative", ("v",)),
    Check("a", "unique", ("id",)),
    Check("b", "unique", ("id",)),
]


def test_run_checks(spark, frames):
    assert rows(quality.run_checks(spark, frames, CHECKS, today())) == [
        ("a", "id", "not_null", 1, "fail"),
        ("a", "id", "unique", 1, "fail"),
        ("a", "v", "non_negative", 1, "fail"),
        ("b", "id", "unique", 0, "pass"),
    ]


def test_row_level_checks_share_a_scan(spark, tmp_path, frames):
    path = str(tmp_path / "a")
    frames["a"].write.parquet(path)
    stored = {"a": spark.read.parquet(path)}
    checks = [Check("a", "not_null", ("id",)), Check("a", "non_negative", ("v",))]
    plan = quality.run_checks(spark, stored, checks, today())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_failures_raise(spark, frames):
    with pytest.raises(quality.QualityError, match="a.id not_null: 1"):
        quality.require_passing(quality.run_checks(spark, frames, CHECKS, today()))
    assert len(quality.require_passing(quality.run_checks(spark, frames, CHECKS[3:], today()))) == 1


def test_unknown_table_or_test(spark, frames):
    with pytest.raises(LookupError):
        quality.run_checks(spark, frames, [*CHECKS, Check("c", "unique", ("id",))], today())
    with pytest.raises(ValueError):
        quality.run_checks(spark, frames, [Check("a", "shiny", ("id",))], today())
