from lakelayers import session
from lakelayers.plans.registered import QUERIES


def test_shuffle_width_follows_the_input_at_any_size():
    assert [session.shuffle_width(n) for n in (0, 1 << 20, 1 << 40, 100 << 40)] == [1, 1, 16384, 1_638_400]


def test_scratch_is_the_shared_folder(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert a.startswith(base + "/x-") and a != b


def test_scratch_is_in_the_warehouse_without_a_checkpoint_folder():
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": "s3a://lake/warehouse"}.get(key, default)

    assert session.scratch_dir(Session, "x").startswith("s3a://lake/warehouse/_scratch/x-")


def test_results_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.pin(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_small_files_are_written_once(spark, tmp_path):
    path = str(tmp_path / "a" / "1.json")
    assert session.write_text(spark, path, "é1")
    assert not session.write_text(spark, path, "other")
    assert session.read_text(spark, path) == "é1"


def test_sizes_are_read_in_bytes(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "3m")
    try:
        assert session.bytes_of(spark, key) == 3 << 20
    finally:
        spark.conf.unset(key)
    assert session.bytes_of(spark, key) > 0


def test_a_months_files_are_bounded_at_small_shares_too(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "16KB")
    try:
        found = QUERIES["part_files"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset(key)
    assert found and all(r.files_bounded for r in found)
