import glob
import os
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers.operators.conform import changed_rows
from lakelayers.operators.merge import DuplicateKeyError, key_range, matched, merge, without_keys
from lakelayers.operators.publish import Layout

NAME = "bronze.t"
BY_MONTH = Layout("day", "month")
SCHEMA = "id bigint, day date, v string"
JAN, FEB, MAR = date(2024, 1, 10), date(2024, 2, 10), date(2024, 3, 10)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def table(spark, store):
    store.replace(NAME, frame(spark, [(1, JAN, "a"), (2, FEB, "b"), (3, FEB, "c")]), BY_MONTH)
    return store


def test_update_insert_and_never_delete(spark, table):
    result = merge(table, NAME, frame(spark, [(2, FEB, "B"), (4, MAR, "d")]), ["id"])
    assert rows(table.read(NAME)) == [(1, JAN, "a"), (2, FEB, "B"), (3, FEB, "c"), (4, MAR, "d")]
    assert result.touched == ["2024-02", "2024-03"]


def test_untouched_parts_are_carried_over(spark, table):
    old = table.version(NAME)
    new = merge(table, NAME, frame(spark, [(2, FEB, "B"), (9, MAR, "n")]), ["id"]).version
    assert new.parts["2024-01"] == old.parts["2024-01"]
    assert new.parts["2024-02"] == new.parts["2024-03"] != old.parts["2024-02"]
    assert table.read(NAME).count() == 4


def test_many_merges_leave_one_folder_a_part(spark, table):
    for n in range(20):
        merge(table, NAME, frame(spark, [(100 + n, FEB, "n")]), ["id"])
    table.expire(NAME, timedelta(0))
    folders = glob.glob(table.path(NAME) + "/_write=*/_part=*")
    assert sorted(f.rsplit("=", 1)[1] for f in folders) == ["2024-01", "2024-02"]
    assert table.read(NAME).count() == 23


def test_insert_only_leaves_what_is_stored(spark, table):
    result = merge(table, NAME, frame(spark, [(1, FEB, "again"), (4, FEB, "d")]), ["id"], insert_only=True)
    assert rows(table.read(NAME)) == [(1, JAN, "a"), (2, FEB, "b"), (3, FEB, "c"), (4, FEB, "d")]
    assert result.touched == ["2024-02"]
    assert merge(table, NAME, frame(spark, [(1, JAN, "again")]), ["id"], insert_only=True).version.number == result.version.number


def test_the_rewritten_part_is_read_once(spark, table):
    plan = without_keys(table.read(NAME), frame(spark, [(2, FEB, "B"), (None, FEB, "x")]), ["id"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows(plan, "id") == [(1,), (3,)]


def test_row_that_moves_to_another_part(spark, table):
    result = merge(table, NAME, frame(spark, [(1, MAR, "moved")]), ["id"])
    assert rows(table.read(NAME)) == [(1, MAR, "moved"), (2, FEB, "b"), (3, FEB, "c")]
    assert result.touched == ["2024-01", "2024-03"]
    assert sorted(result.version.parts) == ["2024-02", "2024-03"]


def test_null_keys_match_nothing(spark, table):
    merge(table, NAME, frame(spark, [(None, FEB, "x")]), ["id"])
    merge(table, NAME, frame(spark, [(None, FEB, "y"), (2, FEB, "B")]), ["id"])
    assert rows(table.read(NAME).filter("id is null"), "v") == [("x",), ("y",)]
    assert table.read(NAME).count() == 5


def test_duplicate_change_keys_are_refused(spark, table):
    with pytest.raises(DuplicateKeyError):
        merge(table, NAME, frame(spark, [(2, FEB, "B"), (2, FEB, "C")]), ["id"])
    assert table.versions(NAME) == [1]
    with pytest.raises(DuplicateKeyError):
        merge(table, "bronze.new", frame(spark, [(2, FEB, "B"), (2, FEB, "C")]), ["id"])


def test_extra_columns_are_left_out_and_missing_ones_refused(spark, table):
    merge(table, NAME, frame(spark, [("more", 2, FEB, "B")], "extra string, id bigint, day date, v string"), ["id"])
    assert table.read(NAME).columns == ["id", "day", "v"]
    assert rows(table.read(NAME).filter("id = 2")) == [(2, FEB, "B")]
    with pytest.raises(ValueError, match="lacks"):
        merge(table, NAME, frame(spark, [(2, FEB)], "id bigint, day date"), ["id"])


def test_first_run_and_empty_target(spark, store):
    merge(store, NAME, frame(spark, []), ["id"], BY_MONTH)
    assert store.read(NAME).count() == 0
    merge(store, NAME, frame(spark, [(1, JAN, "a")]), ["id"])
    assert store.version(NAME).layout == BY_MONTH
    assert rows(store.read(NAME)) == [(1, JAN, "a")]


def test_merging_twice_changes_nothing(spark, table):
    changes = frame(spark, [(2, FEB, "B"), (4, MAR, "d")])
    merge(table, NAME, changes, ["id"])
    once = rows(table.read(NAME))
    merge(table, NAME, changes, ["id"])
    assert rows(table.read(NAME)) == once


def test_no_changes(spark, table):
    before = rows(table.read(NAME))
    assert merge(table, NAME, frame(spark, []), ["id"]).touched == []
    assert rows(table.read(NAME)) == before


def test_composite_key(spark, store):
    schema = "p string, id bigint, v string"
    store.replace(NAME, frame(spark, [("us", 1, "a"), ("uk", 1, "b")], schema))
    merge(store, NAME, frame(spark, [("uk", 1, "B")], schema), ["p", "id"])
    assert rows(store.read(NAME)) == [("uk", 1, "B"), ("us", 1, "a")]


def test_changes_may_be_read_from_the_target(spark, table):
    merge(table, NAME, table.read(NAME).filter("id = 3"), ["id"])
    assert table.read(NAME).count() == 3


def test_late_changes_are_left_out(spark, store):
    schema = "id bigint, at bigint, v string"
    store.replace(NAME, frame(spark, [(1, 10, "a"), (2, 10, "b"), (3, None, "c")], schema))
    changes = frame(spark, [(1, 9, "late"), (2, 10, "same"), (3, 1, "known"), (4, 1, "new")], schema)
    merge(store, NAME, changes, ["id"], newer_by="at")
    assert rows(store.read(NAME), "id", "v") == [(1, "a"), (2, "same"), (3, "known"), (4, "new")]


def test_a_recorded_batch_is_skipped(spark, table):
    for i, value in ((0, "x"), (1, "y"), (1, "z"), (0, "z")):
        merge(table, NAME, frame(spark, [(None, JAN, value)]), ["id"], tag=("stream", i))
    assert rows(table.read(NAME).filter("id is null"), "v") == [("x",), ("y",)]
    assert table.version(NAME).tags == {"stream": 1}


def test_wide_changes_use_a_shuffled_join(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merge(table, NAME, frame(spark, [(2, FEB, "B"), (4, MAR, "d"), (None, JAN, "n")]), ["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(table.read(NAME), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d"), (None, "n")]


def test_only_the_range_of_changed_keys_is_probed(spark):
    df = spark.createDataFrame([("b", 5, 1.0), ("a", 9, 2.0), ("zz", None, 3.0)], "p string, id int, v double")
    near = key_range(df, ["p", "id", "v"])
    probe = spark.createDataFrame([("a", 5), ("b", 9), ("b", 4), ("c", 7), ("a", None)], "p string, id int")
    assert rows(probe.filter(near)) == [("a", 5), ("b", 9)]
    assert key_range(df.filter("id IS NULL"), ["id"]) is None
    assert key_range(df, ["v"]) is None


def test_changed_rows(spark):
    def at(*hours):
        return spark.createDataFrame([(h,) for h in hours], "h int").selectExpr(
            "h", "timestamp'2024-01-01' + make_dt_interval(0, h) AS at"
        )

    source = at(1, 2, 3, 4)
    assert rows(changed_rows(source, None, "at"), "h") == [(1,), (2,), (3,), (4,)]
    assert rows(changed_rows(source, at().limit(0), "at"), "h") == [(1,), (2,), (3,), (4,)]
    assert rows(changed_rows(source, at(1, 2), "at"), "h") == [(3,), (4,)]
    assert rows(changed_rows(source, at(1, 2), "at", timedelta(hours=1)), "h") == [(2,), (3,), (4,)]
    numbers = spark.range(5).toDF("n")
    assert rows(changed_rows(numbers, numbers.filter("n < 3"), "n")) == [(3,), (4,)]


BUCKETED = Layout("day", "month", ("id",), 8)


def many(spark, n=40_000):
    days = "date_add(date'2024-01-01', cast(id % 90 AS int)) AS day"
    return spark.range(0, n, 1, 4).selectExpr("id", days, "sha2(cast(id AS string), 256) AS v")


def written_bytes(store, version):
    """Bytes of each write that the version's parts are in."""
    sizes = {}
    for f in glob.glob(f"{store.path(NAME)}/_write=*/_part=*/*.parquet"):
        write = f.split("_write=")[1].split("/")[0]
        sizes[write] = sizes.get(write, 0) + os.path.getsize(f)
    return sizes


def test_one_row_rewrites_one_bucket_of_one_month(spark, store):
    first = store.replace(NAME, many(spark), BUCKETED)
    assert len(first.parts) == 3 * 8 and {p.split(".")[0] for p in first.parts} == {"2024-01", "2024-02", "2024-03"}
    result = merge(store, NAME, frame(spark, [(7, date(2024, 1, 8), "B")]), ["id"])
    assert len(result.touched) == 1 and result.touched[0].startswith("2024-01.")
    sizes = written_bytes(store, result.version)
    (old,), (new,) = set(first.parts.values()), set(result.version.parts.values()) - set(first.parts.values())
    assert sizes[new] < 1.5 * sizes[old] / 24
    assert store.read(NAME).count() == 40_000 and rows(store.read(NAME).filter("id = 7"), "v") == [("B",)]


def test_a_merge_reads_the_buckets_of_its_keys(spark, store, monkeypatch):
    store.replace(NAME, many(spark, 900), BUCKETED)
    seen, read = [], store.read_version
    monkeypatch.setattr(store, "read_version", lambda name, v, parts=None, with_part=False: seen.append(parts) or read(name, v, parts, with_part))
    merge(store, NAME, frame(spark, [(7, MAR, "moved")]), ["id"])
    assert [len(p) for p in seen] == [3] and len({p.split(".")[1] for p in seen[0]}) == 1
    assert rows(store.read(NAME).filter("id = 7"), "day", "v") == [(MAR, "moved")]
    seen.clear()
    merge(store, NAME, frame(spark, [(8, MAR, "x")]), ["v"])  # by another key: any bucket can hold it
    assert seen == [None]


def test_rows_without_a_key_stay_in_buckets(spark, store):
    store.replace(NAME, frame(spark, [(1, JAN, "a"), (None, JAN, "x"), (None, FEB, "y")]), BUCKETED)
    merge(store, NAME, frame(spark, [(None, JAN, "z"), (1, JAN, "A"), (5, FEB, "n")]), ["id"])
    assert rows(store.read(NAME), "id", "v") == [(1, "A"), (5, "n"), (None, "x"), (None, "y"), (None, "z")]


def test_tables_without_a_date_have_buckets_too(spark, store):
    by_key = Layout(keys=("id",), buckets=16)
    store.replace(NAME, many(spark, 10_000), by_key)
    changed = many(spark, 10_000).filter("id % 2500 = 3").withColumn("v", F.lit("new"))
    result = merge(store, NAME, changed, ["id"])
    assert len(result.touched) <= 4 and store.version(NAME).layout == by_key
    assert store.read(NAME).filter("v = 'new'").count() == 4 and store.read(NAME).count() == 10_000


def test_a_merge_keeps_what_a_table_was_made_of(spark, store):
    source = store.replace("bronze.source", frame(spark, [(1, JAN, "a")]), BY_MONTH)
    store.replace(NAME, frame(spark, [(1, JAN, "a")]), BY_MONTH, sources={"bronze.source": source})
    assert not merge(store, NAME, frame(spark, [(2, FEB, "b")]), ["id"]).version.stale_parts({"bronze.source": source})


def joined_rows(plan):
    """Rows of each side that the executed plan hands to its shuffles."""
    seen, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName() == "Exchange":
            seen.append(node.metrics().apply("shuffleRecordsWritten").value())
        inner = node.plan() if node.nodeName().endswith("QueryStage") else None
        todo += [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
    return seen


def test_spread_keys_skip_stored_rows_by_a_bloom_filter(spark, store):
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", prefix + "applicationSideScanSizeThreshold": "0"}
    store.replace(NAME, many(spark), BY_MONTH)
    with store.staging() as stage:
        fresh = stage(many(spark).filter("id % 400 = 1").withColumn("v", F.lit("new")))
        near, target = key_range(fresh, ["id"]), store.read_version(NAME, store.version(NAME), with_part=True)
        before = {k: spark.conf.get(k) for k in conf}
        counts = {}
        for enabled in ("true", "false"):
            for key, value in {**conf, prefix + "enabled": enabled}.items():
                spark.conf.set(key, value)
            try:
                hit = matched(target.filter(near), fresh, ["id"], near)
                assert ("might_contain" in hit._jdf.queryExecution().executedPlan().toString()) == (enabled == "true")
                assert len(hit.collect()) == 100
                counts[enabled] = max(joined_rows(hit._jdf.queryExecution().executedPlan()))
            finally:
                for key, value in {**before, prefix + "enabled": "true"}.items():
                    spark.conf.set(key, value)
    assert counts["false"] > 39_000 and counts["true"] < 5_000


def marked(spark, data):
    nested = "struct(id AS a, struct(id * 5 AS b, 'x' AS c) AS d) AS more"
    return spark.createDataFrame(data, "id bigint, day date, at timestamp").selectExpr(nested, "id", "day", "at")


def test_the_mark_is_read_from_the_footers(spark, store):
    layout = Layout("day", "month", mark="at")
    at = [datetime(2024, 1, n, 5, 6, 7, 89) for n in range(1, 6)]
    store.replace(NAME, marked(spark, [(1, JAN, at[0]), (2, FEB, at[2]), (3, FEB, None)]), layout)
    v = store.version(NAME)
    plan = store.marks(NAME, v).agg(F.max("_mark"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(_mark)]" in plan

    def newest():
        found = store.newest(NAME, store.version(NAME))
        return None if found is None else spark.range(1).select(found).first()[0]

    assert newest() == at[2] == store.read(NAME).agg(F.max("at")).first()[0]
    merge(store, NAME, marked(spark, [(2, FEB, at[1]), (1, JAN, at[4])]), ["id"])
    assert newest() == at[4]
    assert "_mark" not in store.read(NAME).columns
    store.replace(NAME, marked(spark, [(3, FEB, None)]), layout)
    assert newest() is None
    store.replace(NAME, marked(spark, []), layout)
    assert newest() is None


def test_failing_parts_are_known_from_the_write(spark, store):
    tests = {"not_null v": F.col("v").isNull()}
    store.replace(NAME, frame(spark, [(1, JAN, None), (2, FEB, "b"), (3, MAR, None), (4, MAR, None)]), BY_MONTH, tests=tests)
    assert store.version(NAME).failing == {"not_null v": ["2024-01", "2024-03"]}
    merge(store, NAME, frame(spark, [(1, JAN, "fixed"), (2, FEB, None)]), ["id"], tests=tests)
    assert store.version(NAME).failing == {"not_null v": ["2024-02", "2024-03"]}
    merge(store, NAME, frame(spark, [(2, FEB, "b")]), ["id"], tag=("s", 1), tests=tests)
    merge(store, NAME, frame(spark, []), ["id"], tag=("s", 2), tests=tests)
    assert store.version(NAME).failing == {"not_null v": ["2024-03"]}
    merge(store, NAME, frame(spark, [(2, FEB, None)]), ["id"])  # written without being told to count
    assert store.version(NAME).failing == {}
