import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers import Context, settings
from lakelayers.operators import conform
from lakelayers.operators.publish import TableStore
from lakelayers.plans import bronze
from lakelayers.sources import seeds
from lakelayers.sources.benchmark import SCHEMAS, BenchmarkSources
from lakelayers.sources.registry import SOURCES, ParquetSources, declared_stores

SMALL = "/root/testdata/sf0.001"

# --- fixed values: the product seed, padded as delivered -------------------
SEED = (
    "product_id,product_name,category,price\n"
    "  1,Airlift Legging,Bottoms,128.00" + " " * 140 + "\n"
    "  2,Define Jacket,Tops,168.00" + " " * 140 + "\n"
    "  3,Warrior Mat,Accessories,96.00" + " " * 140
)


@pytest.fixture
def seed(tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(SEED)
    return str(path)


def test_padded_seed(spark, seed):
    df = seeds.read_seed(spark, seed, seeds.SEED_TYPES["products"])
    assert rows(bronze.products_with_tax(df)) == [
        (1, "Airlift Legging", "Bottoms", 128.0, 140.8),
        (2, "Define Jacket", "Tops", 168.0, 184.8),
        (3, "Warrior Mat", "Accessories", 96.0, 105.6),
    ]


def test_seed_types_can_be_overridden(spark, seed):
    df = seeds.read_seed(spark, seed, seeds.SEED_TYPES["products"], {"price": "string"})
    assert df.schema["price"].dataType == T.StringType()
    assert df.filter("product_id = 1").first()["price"] == "128.00"
    assert set(seeds.SEED_TYPES["cq"].values()) == {"string"}


def test_seed_with_a_bad_number_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("product_id,product_name,category,price\nx,A,B,1.0\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        seeds.read_seed(spark, str(path), seeds.SEED_TYPES["products"]).collect()


def test_declared_sources():
    batch = [s for s in SOURCES.values() if not s.streaming]
    assert len(SOURCES) == 11
    assert sum(len(s.tables) for s in SOURCES.values()) == 40
    assert len(batch) == 7 and sum(len(s.tables) for s in batch) == 32
    assert all(s.limits and s.loaded_at for s in batch)


def test_undeclared_source_is_refused(spark, tmp_path):
    sources = ParquetSources(spark, str(tmp_path))
    with pytest.raises(LookupError):
        sources.scan(settings.STORE_RETAIL_SOURCES["yoga-us"], "orders")
    with pytest.raises(LookupError):
        sources.scan("src_shopify_uk", "refund")
    assert "yoga-us" not in declared_stores(settings.STORE_RETAIL_SOURCES)
    assert declared_stores(settings.STORE_SOURCES) == settings.STORE_SOURCES


def test_parquet_sources_and_separate_roots(spark, tmp_path):
    prod, dev = str(tmp_path / "prod"), str(tmp_path / "dev")
    raw = BenchmarkSources(spark, SMALL)
    for store, source in settings.STORE_SOURCES.items():
        raw.scan(source, "orders").write.parquet(f"{prod}/{source}/orders")
    ctx = Context(spark, ParquetSources(spark, prod), TableStore(spark, dev))
    ctx.tables.replace("bronze.orders", bronze.all_orders(ctx))
    want = bronze.all_orders(Context(spark, raw))
    got = ctx.ref("bronze.orders")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_union_of_stores_allows_missing_columns(spark):
    frames = {"a": spark.range(2), "b": spark.range(3).withColumn("extra", F.lit("x"))}
    out = conform.union_stores({"s1": "a", "s2": "b"}, frames.__getitem__)
    assert out.columns == ["id", "platform", "extra"]
    assert rows(out.groupBy("platform").count()) == [("s1", 2), ("s2", 3)]


@pytest.mark.parametrize("table", SCHEMAS)
def test_declared_columns_are_those_stored(spark, table):
    stored = spark.read.parquet(f"{SMALL}/{table}.parquet").schema
    declared = BenchmarkSources(spark, SMALL).table(table).schema
    assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in stored]


def test_both_store_readings_agree(spark):
    ctx = Context(spark, BenchmarkSources(spark, SMALL))
    one_scan = bronze.all_orders(ctx)
    per_store = bronze.orders(
        conform.union_stores(settings.STORE_SOURCES, lambda s: ctx.source(s, "orders")), F.col("platform")
    )
    assert one_scan.exceptAll(per_store).isEmpty() and per_store.exceptAll(one_scan).isEmpty()


def test_stream_source(spark, tmp_path):
    raw = BenchmarkSources(spark, SMALL).scan("src_shopify_us", "orders")
    raw.write.parquet(str(tmp_path / "br_src_shopify_us" / "orders"))
    sources = ParquetSources(spark, str(tmp_path), {("br_src_shopify_us", "orders"): raw.schema})
    stream = sources.stream("br_src_shopify_us", "orders", max_files=1)
    assert stream.isStreaming and stream.schema.names == raw.schema.names
