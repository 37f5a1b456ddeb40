"""Mixing, digest index and sharding beyond what the SQL comparison covers."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers.llm import digest_index, feistel, mixing
from lakelayers.session import scratch_dir

# --- mixing ----------------------------------------------------------------------


def levels(sizes: dict, weights=mixing.WEIGHTS, epochs=mixing.MAX_EPOCHS) -> dict:
    """Clamp what exceeds its cap, reshare the rest by weight, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: epochs * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 7}, {"a": 1}, {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 2, "c": 3, "d": 10_000, "e": 50, "é": 60, "": 4},
])
def test_targets_are_the_water_level(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(levels(sizes))


def test_all_sizes_zero(spark):
    df = spark.createDataFrame([("a", 0), (None, 0)], "source string, size long")
    assert rows(mixing.targets(df), "target") == [(0.0,), (0.0,)]


def test_a_mixture_comes_near_its_targets(given):
    got = mixing.mix(given).collect()
    taken, biggest, target = Counter(), Counter(), {}
    for r in got:
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= biggest[s] / 2 + 1 for s in target)
    again = mixing.mix(given.repartition(7)).collect()
    assert sorted(again) == sorted(got)


def test_documents_come_as_often_as_the_mixture_says(given):
    want = {r.doc_id: r.copies for r in mixing.mix(given).collect() if r.copies}
    got = mixing.mixed_documents(given)
    assert got.columns == given.columns
    assert Counter(r.doc_id for r in got.collect()) == want


def test_odd_mixture(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert Counter(r.text for r in mixing.mixed_documents(odd.where("size(split(text, ' ')) > 1")).collect())
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []


def test_a_hot_repeated_row_is_taken_in_part(spark):
    docs = spark.range(400).selectExpr("7L AS doc_id", "'one two three four' AS text", "'b' AS source").unionByName(
        spark.range(400).selectExpr("id AS doc_id", "concat('w ', id) AS text", "'a' AS source")
    )
    found = mixing.mix(docs)
    sums = {r.source: (r.t, r.target) for r in found.groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()}
    assert all(abs(t - target) <= 3 for t, target in sums.values())


# --- digest index ----------------------------------------------------------------


def test_batches_are_held_against_the_index(spark):
    path = scratch_dir(spark, "index")
    index = digest_index.DigestIndex.open(spark, path, 4)
    schema = "doc_id bigint, text string"
    first = index.add(spark.createDataFrame([(1, "a b"), (2, "ab "), (3, "c")], schema))
    assert rows(first, "doc_id", "keep_id", "group_size", "kept") == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)]
    again = digest_index.DigestIndex.open(spark, path, 4)  # as a later session would
    second = again.add(spark.createDataFrame([(4, "a  b  longer? no"), (5, "a     b"), (6, "c"), (7, "c")], schema))
    assert rows(second, "doc_id", "keep_id", "group_size", "kept") == [(4, 4, 1, True), (5, 1, 1, False), (6, 3, 2, False), (7, 3, 2, False)]
    assert rows(again.read(), "keep_id") == [(1,), (3,), (4,)]
    plan = again.read().join(spark.table(again.table).hint("merge").select("text_sha256"), "text_sha256", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Bucketed: true") == 2 and "Exchange" not in text


def test_a_batch_that_is_added_again_has_the_same_outcome(spark, tmp_path):
    schema, path = "doc_id bigint, text string", f"file://{tmp_path}/index"
    decided = ("doc_id", "keep_id", "group_size", "kept")
    one = spark.createDataFrame([(1, "a b"), (2, "ab "), (3, "c")], schema)
    two = spark.createDataFrame([(4, "c"), (5, "d"), (6, "d "), (None, "e")], schema)
    with digest_index.DigestIndex.open(spark, path, 4) as index:
        first = rows(index.add(one, "one"), *decided)
    with digest_index.DigestIndex.open(spark, path, 4) as index:  # the driver was lost, and asks again
        assert rows(index.add(one, "one"), *decided) == first
        held = rows(index.read())
        assert sorted(r[1] for r in held) == [1, 3]
        second = rows(index.add(two, "two"), *decided)
        assert second == sorted([(4, 3, 1, False), (5, 6, 2, False), (6, 6, 2, True), (None, None, 1, True)], key=repr)
        held = rows(index.read())
        # Half of the batch's digests are lost, as if their files had not been finished.
        some = spark.createDataFrame([r for r in held if r[3] == "one" or r[1] == 6], index.read().schema).collect()
    other = f"file://{tmp_path}/other"
    with digest_index.DigestIndex.open(spark, other, 4) as index:
        spark.createDataFrame(some, index.read().schema).repartition(4, "text_sha256").write.insertInto(index.table)
        assert rows(index.add(two, "two"), *decided) == second
        assert rows(index.read()) == held
        assert rows(index.add(one, "one"), *decided) == first
        assert rows(index.add(two, "three"), "kept") == [(False,)] * 4
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index_") and t.name == index.table]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_give_the_whole_tables_outcome(spark, given, batches):
    spaced = given.withColumn("text", F.expr("translate(text, ' ', '')")).withColumn("doc_id", F.expr("doc_id + 1000000"))
    docs = given.unionByName(spaced).unionByName(given.withColumn("doc_id", F.expr("doc_id - 1000000")))
    found = digest_index.deduplicate(docs, 4, batches)
    whole = digest_index.deduplicate(docs, 4, 1)
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(found, *columns) == rows(whole, *columns)
    before = {t.name for t in spark.catalog.listTables()}
    digest_index.deduplicate(docs, 4, batches)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_odd_digests(odd, none):
    got = digest_index.deduplicate(odd).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    assert len(got) == odd.count() and all(sum(r.kept for r in g) == 1 and {r.group_size for r in g} == {len(g)} for g in by.values())
    assert {r.doc_id: r.keep_id for r in got if r.doc_id in (1, 2, 3, 4, 5, 6)} == {1: 3, 2: 3, 3: 3, 4: 6, 5: 6, 6: 6}
    kept = digest_index.distinct_documents(odd)
    assert kept.columns == odd.columns and kept.count() == len(by)
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in odd.collect()}
    assert digest_index.deduplicate(none).collect() == [] and digest_index.distinct_documents(none).collect() == []


def test_longest_then_smallest_stays(spark):
    docs = spark.createDataFrame([(5, "a b"), (3, "a  b"), (9, "a  b"), (None, "a  b"), (1, "ab")], "doc_id bigint, text string")
    assert {r.keep_id for r in digest_index.deduplicate(docs).collect()} == {3}
    assert rows(digest_index.distinct_documents(docs), "doc_id") == [(3,)]


# --- sharding ----------------------------------------------------------------------


@pytest.mark.parametrize("count", [1, 2, 3, 15, 16, 17, 64, 1000, 4097])
def test_a_permutation_at_every_size(count):
    got = feistel.permute(np.arange(count), count)
    assert sorted(got.tolist()) == list(range(count))
    assert count < 64 or got.tolist() != list(range(count))


def test_big_row_numbers():
    rows_ = 10**12 + 7
    some = np.array([0, 1, 2, 10**9, rows_ - 1])
    got = feistel.permute(some, rows_)
    assert len(set(got.tolist())) == 5 and got.min() >= 0 and got.max() < rows_
    assert feistel.permute(some, rows_, seed=1).tolist() != got.tolist()


def test_shards_are_even_gapless_and_computable(given):
    got = feistel.assign(given).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert feistel.locate(r.row_number, len(got)) == (r.shard, r.slot)
    assert sorted(r.row_number for r in got) == list(range(len(got)))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [r.doc_id for r in sorted(got, key=lambda r: r.row_number)] == sorted(r.doc_id for r in got)


def test_odd_shards(odd, none):
    got = feistel.assign(odd).collect()
    assert len({(r.shard, r.slot) for r in got}) == odd.count()
    assert {r["size"] for r in got if r.doc_id in (4, 5)} == {1}
    again = feistel.assign(odd.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32, r.shard, r.slot)
    assert [key(r) for r in sorted(again, key=key)] == [key(r) for r in sorted(got, key=key)]
    assert feistel.assign(none).collect() == []


def test_a_large_batch_meets_a_filled_index(spark, tmp_path):
    index = digest_index.DigestIndex.open(spark, f"file://{tmp_path}/index", 8)
    text = F.when(F.col("doc_id") % 10 < 3, F.lit("hot text")).otherwise(F.concat(F.lit("text "), (F.col("doc_id") % 5000).cast("string")))
    docs = spark.range(30_000).withColumnRenamed("id", "doc_id").withColumn("text", text)
    index.add(docs.where("doc_id < 10000")).count()
    held = {r.text_sha256: r.keep_id for r in index.read().collect()}
    assert len(held) == 3501
    # As many hot rows, texts the index holds and texts it does not.
    more = docs.where("doc_id >= 10000").withColumn("text", F.when(F.col("doc_id") % 20 == 9, F.concat("text", F.lit(" new"))).otherwise(F.col("text")))
    found = index.add(more).collect()
    assert len(found) == 20_000
    for r in found:
        if r.text_sha256 in held:
            assert (r.keep_id, r.kept) == (held[r.text_sha256], False)
        else:
            assert r.kept == (r.doc_id == r.keep_id) and r.doc_id % 20 == 9
    assert index.read().count() == len({*held, *[r.text_sha256 for r in found]}) == 3501 + 250


def test_targets_of_many_sources(spark):
    sizes = [(None if n == 0 else f"s{n:05d}", (n * 37) % 101) for n in range(6000)]
    got = mixing.targets(spark.createDataFrame(sizes, "source string, size long"))
    windows = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in line]
    assert all("_block" in line for line in windows)
    order = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(order)}
    left, open_, full = sum(n for _, n in sizes), dict(sizes), {}
    while True:
        total = sum(weight[o] for o in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * open_[s]]
        if not over:
            break
        for s in over:
            full[s] = 3 * open_.pop(s)
        left = sum(n for _, n in sizes) - sum(full.values())
    want = full | {s: left * weight[s] / total for s in open_}
    have = {r.source: r.target for r in got.collect()}
    assert have.keys() == want.keys() and all(have[s] == pytest.approx(want[s]) for s in want)
