import glob
import os
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers.operators.merge import merge
from lakelayers.operators.publish import Layout, TableStore, as_view


def days(spark, n=100, start="2024-01-01", first=0):
    return spark.range(first, first + n).select(
        "id", F.date_add(F.lit(start).cast("date"), (F.col("id") % 90).cast("int")).alias("day")
    )


BY_MONTH = Layout("day", "month")


def test_replace_may_read_the_table_it_replaces(spark, store):
    store.replace("bronze.t", spark.range(5).toDF("id"))
    before = store.read("bronze.t")
    store.replace("bronze.t", before.withColumn("id", F.col("id") + 100))
    assert rows(store.read("bronze.t")) == [(i,) for i in range(100, 105)]
    assert rows(before) == [(i,) for i in range(5)]


def test_missing_table_and_empty_table(spark, store):
    with pytest.raises(LookupError):
        store.read("bronze.none")
    store.replace("bronze.t", spark.range(0).toDF("id"))
    assert store.read("bronze.t").count() == 0
    assert store.read("bronze.t").columns == ["id"]


def test_versions_go_by_age_and_never_the_newest(spark, store):
    for i in range(5):
        store.replace("aged.t", spark.range(i).toDF("id"))
    store.expire("aged.t")
    assert store.versions("aged.t") == [1, 2, 3, 4, 5]
    store.expire("aged.t", timedelta(0))
    assert store.versions("aged.t") == [5]
    assert store.read("aged.t").count() == spark.table("aged.t").count() == 4
    assert len(glob.glob(store.path("aged.t") + "/_write=*")) == 1
    assert len(spark.sql("SHOW TABLES IN aged LIKE 't__v*'").collect()) == 1


def test_what_the_view_names_is_not_expired(spark, tmp_path):
    published = TableStore(spark, str(tmp_path / "one"))
    published.replace("named.t", spark.range(2).toDF("id"))
    silent = TableStore(spark, str(tmp_path / "one"), catalog=False)
    silent.replace("named.t", spark.range(3).toDF("id"))
    silent.expire("named.t", timedelta(0))
    assert spark.table("named.t").count() == 2 and silent.read("named.t").count() == 3


def test_rows_of_a_job_that_died_are_never_read(spark, store):
    store.replace("bronze.t", spark.range(3).toDF("id"))
    store.write_rows("bronze.t", spark.range(50).toDF("id"), Layout())
    assert store.read("bronze.t").count() == 3
    store.expire("bronze.t")
    assert len(glob.glob(store.path("bronze.t") + "/_write=*")) == 2  # a writer may still be at it
    store.expire("bronze.t", timedelta(0))
    assert len(glob.glob(store.path("bronze.t") + "/_write=*")) == 1
    assert store.read("bronze.t").count() == 3


def test_a_store_outside_the_catalog(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), catalog=False)
    for i in range(3):
        store.replace("unlisted.t", spark.range(i + 1).toDF("id"))
    store.expire_all(timedelta(0))
    assert store.versions("unlisted.t") == [3] and store.read("unlisted.t").count() == 3
    assert not spark.catalog.databaseExists("unlisted")


def test_a_version_is_published_once(spark, store):
    v = store.replace("bronze.t", spark.range(3).toDF("id"))
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit("bronze.t", v)


def test_parts_are_pruned_and_files_sorted(spark, store):
    store.replace("bronze.t", days(spark, 1000), BY_MONTH)
    v = store.version("bronze.t")
    assert sorted(v.parts) == ["2024-01", "2024-02", "2024-03"]
    assert store.read("bronze.t", parts=["2024-02"]).agg(F.min("day"), F.max("day")).first()[:] == (
        date(2024, 2, 1), date(2024, 2, 29),
    )
    for file in glob.glob(store.path("bronze.t") + "/_write=*/_part=*/*.parquet"):
        seen = [r.day for r in spark.read.parquet(file).collect()]
        assert seen == sorted(seen)


def test_rows_without_a_date_have_their_own_part(spark, store):
    df = days(spark, 10).unionByName(spark.sql("SELECT 999L AS id, CAST(NULL AS date) AS day"))
    assert sorted(store.replace("bronze.t", df, BY_MONTH).parts) == ["2024-01", "none"]
    assert store.read("bronze.t").count() == 11


def test_days_are_read_from_their_parts_only(spark, store):
    df = days(spark, 90).unionByName(spark.sql("SELECT 999L AS id, CAST(NULL AS date) AS day"))
    v = store.replace("bronze.t", df, BY_MONTH)
    found = store.read("bronze.t", dates=(date(2024, 2, 27), date(2024, 3, 2)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-02" in plan and "2024-03" in plan and "2024-01" not in plan and "none" not in plan
    assert found.count() == 5
    files = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert {f.split("_part=")[1].split("/")[0] for f in files} == {"2024-02", "2024-03"}
    assert Layout("day", "year").between(["2023", "2024", "none"], date(2024, 1, 1), date(2024, 2, 1)) == ["2024"]
    assert v.layout.between(v.parts, date(2025, 1, 1), date(2025, 2, 1)) == []


def test_a_part_is_one_file(spark, store):
    store.replace("bronze.t", days(spark, 1000).repartition(8), BY_MONTH)
    assert len(glob.glob(store.path("bronze.t") + "/_write=*/_part=*/*.parquet")) == 3


def test_date_filter_is_pushed_to_the_scan(spark, store):
    store.replace("bronze.t", days(spark), BY_MONTH)
    plan = store.read("bronze.t").filter("day > date'2024-02-03'").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(day,2024-02-03)" in text
    assert "ReadSchema: struct<id:bigint,day:date>" in text


def test_replace_parts_leaves_the_others(spark, store):
    store.replace("bronze.t", days(spark, 90), BY_MONTH)
    old = store.version("bronze.t")
    feb = store.read("bronze.t", parts=["2024-02"]).withColumn("id", F.col("id") + 1000)
    new = store.replace_parts("bronze.t", feb, ["2024-02"])
    assert new.parts["2024-01"] == old.parts["2024-01"] != new.parts["2024-02"]
    assert store.read("bronze.t").filter("id >= 1000").count() == 29
    with pytest.raises(ValueError, match="outside"):
        store.replace_parts("bronze.t", days(spark, 90), ["2024-02"])
    gone = store.replace_parts("bronze.t", feb.limit(0), ["2024-02"])
    assert sorted(gone.parts) == ["2024-01", "2024-03"]


def test_view_follows_every_commit_and_earlier_plans_stay_readable(spark, store):
    store.replace("flip.t", days(spark, 90), BY_MONTH)
    before = spark.table("flip.t")
    store.replace("flip.t", days(spark, 20), BY_MONTH)
    assert spark.table("flip.t").columns == ["id", "day"]
    assert spark.table("flip.t").count() == 20
    store.replace("flip.t", days(spark, 5), BY_MONTH)
    store.expire_all()
    assert before.count() == 90 and spark.table("flip.t").count() == 5


def test_an_unchanged_version_is_not_published_again(spark, store, monkeypatch):
    store.replace("again.a", spark.range(2).toDF("id"))
    store.replace("again.b", spark.range(3).toDF("id"))
    shown = store._shown("again.b")
    spark.sql("DROP VIEW again.a")
    assert store.publish_views() == ["again.a", "again.b"]
    assert spark.table("again.a").count() == 2 and store._shown("again.b") == shown


def test_view_models_are_planned_anew(spark, store):
    store.replace("base.numbers", spark.range(4).toDF("id"))
    as_view(spark, "upper.numbers", "SELECT id * 2 AS id FROM base.numbers")
    as_view(spark, "top.numbers", "SELECT sum(id) AS s FROM upper.numbers")
    assert rows(spark.table("top.numbers")) == [(12,)]
    store.replace("base.numbers", spark.range(2).toDF("id"))
    assert rows(spark.table("top.numbers")) == [(2,)]


def test_staging_is_removed(spark, store):
    with store.staging() as stage:
        staged = stage(spark.range(5))
        assert staged.count() == 5
    assert os.listdir(store.root + "/_staging") == []


def test_a_hot_date_is_written_by_several_tasks(spark, store):
    one_day = spark.range(0, 400_000, 1, 8).select("id", F.rand(1).alias("v"), F.lit("2024-01-01").cast("date").alias("day"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        store.replace("bronze.t", one_day, BY_MONTH)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(store.path("bronze.t") + "/_write=*/_part=*/*.parquet")) > 3
    assert store.read("bronze.t").count() == 400_000


def test_a_commit_tells_the_catalog_what_changed(spark, store, monkeypatch):
    store.replace("told.t", days(spark, 900), Layout("day", "month", ("id",), 16))
    said = []

    class Listening:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text, **more):
            said.append(text)
            return spark.sql(text, **more)

    monkeypatch.setattr(store, "spark", Listening())
    before = spark.table("told.t")
    for n in range(3):
        said.clear()
        merge(store, "told.t", spark.sql(f"SELECT {n}L AS id, date'2024-01-01' + {n} AS day"), ["id"])
        changes = [t for t in said if "PARTITION (" in t]
        assert len(said) <= 4 and len(changes) == 1 and changes[0].count("PARTITION (") == 1
    assert spark.table("told.t").count() == before.count() == 900
    assert spark.sql(f"SHOW PARTITIONS {store._shown('told.t').table}").count() == 48 + 3
    store.expire("told.t", timedelta(0))
    assert spark.sql(f"SHOW PARTITIONS {store._shown('told.t').table}").count() == 48
    assert spark.table("told.t").count() == 900


def test_a_view_of_new_columns_has_a_table_of_its_own(spark, store):
    store.replace("grown.t", days(spark, 5), BY_MONTH)
    store.replace("grown.t", days(spark, 7).withColumn("more", F.lit(1)), BY_MONTH)
    assert spark.table("grown.t").columns == ["id", "day", "more"] and spark.table("grown.t").count() == 7
    assert spark.sql("SHOW TABLES IN grown LIKE 't__v*'").count() == 1


def test_a_view_catches_up_with_commits_outside_the_catalog(spark, store):
    store.replace("behind.t", days(spark, 90), BY_MONTH)
    silent = TableStore(spark, store.root, catalog=False)
    merge(silent, "behind.t", spark.sql("SELECT 1L AS id, date'2024-02-02' AS day"), ["id"])
    merge(silent, "behind.t", spark.sql("SELECT 999L AS id, date'2024-03-02' AS day"), ["id"])
    assert spark.table("behind.t").count() == 90
    store.publish_views()
    assert spark.table("behind.t").count() == 91 and spark.table("behind.t").filter("id = 1").first().day == date(2024, 2, 2)


def test_days_are_found_in_buckets(spark, store):
    layout = Layout("day", "month", ("id",), 4)
    v = store.replace("bronze.t", days(spark, 900), layout)
    assert sorted(layout.between(v.parts, date(2024, 2, 3), date(2024, 2, 9))) == [f"2024-02.{b}" for b in range(4)]
    assert store.read("bronze.t", dates=(date(2024, 2, 3), date(2024, 2, 9))).count() == 70
    assert sorted(layout.holding(v.parts, [2])) == ["2024-01.2", "2024-02.2", "2024-03.2"]
