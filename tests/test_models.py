import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers import Context
from lakelayers.plans.models import Model, run_model

NAME = "bronze.numbers"


@pytest.fixture
def ctx(spark, store):
    return Context(spark, None, store)


def numbers(n, add=0):
    def build(ctx):
        return ctx.spark.range(n).select("id", (F.col("id") + add).alias("v"), F.lit(add).alias("at"))

    return build


def test_default_is_a_view_and_jobs_ask_for_tables(spark, ctx, store):
    model = Model("seen.numbers", lambda ctx: "SELECT id, id AS v FROM range(3)")
    assert run_model(ctx, model).version is None
    assert spark.table("seen.numbers").count() == ctx.ref("seen.numbers").count() == 3
    assert store.versions("seen.numbers") == []
    ctx.materialization = "table"
    assert run_model(ctx, model).version == 1
    assert ctx.ref("seen.numbers").count() == 3


def test_a_table_with_the_same_inputs_is_left_alone(ctx):
    total = Model("gold.total", lambda c: c.ref(NAME).agg(F.sum("v").alias("s")), "table", inputs=(NAME,))
    run_model(ctx, Model(NAME, numbers(3), "table"))
    assert [run_model(ctx, total).version for _ in range(2)] == [1, 1]
    run_model(ctx, Model(NAME, numbers(4), "table"))
    assert run_model(ctx, total).version == 2 and rows(ctx.ref("gold.total")) == [(6,)]
    assert run_model(ctx, total, full_refresh=True).version == 3


def test_a_view_may_read_a_view(ctx, spark):
    run_model(ctx, Model("base.t", numbers(5), "table"))
    run_model(ctx, Model("mid.t", lambda c: "SELECT v FROM base.t WHERE v > 1", "view"))
    run_model(ctx, Model("end.t", lambda c: "SELECT count(*) AS n FROM mid.t", "view"))
    assert rows(ctx.ref("end.t")) == [(3,)]
    run_model(ctx, Model("base.t", numbers(9), "table"))
    assert rows(ctx.ref("end.t")) == [(7,)]


def test_table_is_rebuilt(ctx):
    run_model(ctx, Model(NAME, numbers(5), "table"))
    run_model(ctx, Model(NAME, numbers(2), "table"))
    assert ctx.ref(NAME).count() == 2


def test_incremental_and_full_refresh(ctx):
    def model(n, add):
        return Model(NAME, numbers(n, add), "incremental", unique_key=("id",), changed_on="at")

    run_model(ctx, model(5, 0))
    run_model(ctx, model(2, 0))
    assert rows(ctx.ref(NAME), "id", "v") == [(i, i) for i in range(5)]
    run_model(ctx, model(2, 10))
    assert rows(ctx.ref(NAME), "id", "v") == [(0, 10), (1, 11), (2, 2), (3, 3), (4, 4)]
    run_model(ctx, model(1, 0), full_refresh=True)
    assert rows(ctx.ref(NAME), "id", "v") == [(0, 0)]


def test_models_read_each_other_by_name(ctx):
    run_model(ctx, Model(NAME, numbers(3), "table"))
    run_model(ctx, Model("silver.total", lambda c: c.ref(NAME).agg(F.sum("v").alias("s")), "table"))
    assert rows(ctx.ref("silver.total")) == [(3,)]


def test_read_by_name_and_preview(ctx, store):
    run_model(ctx, Model("named.numbers", numbers(30), "table"))
    assert ctx.table("named.numbers").count() == 30
    assert ctx.preview("named.numbers", 5).count() == 5
    assert rows(ctx.preview("named.numbers", 2, ["id"]), "id") == [(0,), (1,)]


def test_bad_models(ctx):
    with pytest.raises(ValueError, match="unknown"):
        run_model(ctx, Model(NAME, numbers(1), "cube"))
    with pytest.raises(ValueError, match="needs"):
        run_model(ctx, Model(NAME, numbers(1), "incremental"))
    with pytest.raises(ValueError, match="SQL text"):
        run_model(ctx, Model(NAME, numbers(1), "view"))
