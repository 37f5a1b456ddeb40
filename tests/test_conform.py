from conftest import rows
from pyspark.sql import functions as F

from lakelayers.operators import conform


def test_latest_per_key_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n"), (2, 1, "y"), (3, None, None)], "k int, at int, v string"
    )
    assert rows(conform.latest_per_key(df, ["k"], ["at"])) == [(1, 5, "b"), (2, 1, "y"), (3, None, None)]


def test_latest_per_key_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (1, 1, "b"), (1, 2, "c")], "k int, at int, v string")
    assert rows(conform.latest_per_key(df, ["k"], ["at"])) == [(1, 2, "c"), (None, 1, "a"), (None, 1, "a")]


def test_latest_per_key_carries_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)) AS t(k, at, m)")
    assert [r.m for r in conform.latest_per_key(df, ["k"], ["at"]).collect()] == [{"b": 2}]


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = conform.latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_dimension_join_is_planned_without_a_job(spark):
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 3 != 0, F.col("id"))
    fact = spark.range(3000).select("id", key.alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    spark.sparkContext.setJobGroup("planning", "no job may run")
    joined = conform.join_dimension(fact, dim, ["k"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert joined.count() == 3000 and joined.filter("d = 70").count() == 1501  # the hot key, and row 7


def test_cutoff_keeps_the_day_itself(spark):
    df = spark.sql("SELECT * FROM VALUES (date'2022-12-29'), (date'2022-12-30'), (date'2022-12-31'), (NULL) AS t(d)")
    assert len(rows(conform.from_cutoff(df, "d", "2022-12-30"))) == 2


def test_the_sql_and_the_operator_are_one_rule(spark):
    schema = "p string, id bigint, at int, a string, b double, m map<string,int>"
    data = [
        ("x", 1, 1, "a", 1.0, None), ("x", 1, 1, "b", 0.0, {"k": 1}), ("x", 1, None, "z", 9.0, None), ("x", 2, None, None, None, None),
        ("x", 2, None, "q", None, None), ("x", None, 5, "n", 1.0, None), ("x", None, 5, "n", 1.0, None), (None, 1, 5, "n", 1.0, None),
        ("y", 1, 3, "late", None, None), ("y", 1, 4, "later", None, None),
    ]
    df = spark.createDataFrame(data, schema)
    df.createOrReplaceTempView("given_rows")
    by_sql = spark.sql(conform.latest_sql("given_rows", df.schema, ["p", "id"], ["at"]))
    want = [(None, 1, "n"), ("x", 1, "b"), ("x", 2, "q"), ("x", None, "n"), ("x", None, "n"), ("y", 1, "later")]
    assert rows(conform.latest_per_key(df, ["p", "id"], ["at"]), "p", "id", "a") == rows(by_sql, "p", "id", "a") == sorted(want, key=repr)
    assert by_sql.columns == df.columns


def test_marks_of_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None), (None, 2)], "g string, n int")
    assert rows(conform.high_water_marks(df, "g", "n")) == [("a", 3), (None, 2)]
