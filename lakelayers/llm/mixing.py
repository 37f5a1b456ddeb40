"""Mixing sources to target weights by capped water-filling; native throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakelayers.llm.common import free, row_numbers, running_total, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7
# Documents of a source are dealt to so many equal slices of the hash range, and
# only the slice in which the sample ends is put in order.
SLICE_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits that say where a row stands in the seeded order."""
    row = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources by code point, null last, take ``weights`` in turn and share the
    sum of all sizes. Clamping what exceeds ``max_epochs`` times its size and
    resharing the rest by weight until nothing exceeds comes to one water
    level: sources fill up in the order of cap by weight, and the level is the
    first at which the sources still open take what is left. Sources are numbered
    by range sorts and totalled in blocks, so no task holds them all.
    """
    held = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turned = row_numbers(held, [F.col("source").asc_nulls_last()], "mix-turns", "turn")
    turn = (F.col("turn") % len(weights) + 1).cast("int")
    weighed = turned.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    # Equal ratios may stand in any order, but in one.
    fill = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    placed = written(row_numbers(weighed, fill, "mix-places", "place"), "mix-fill")
    whole = placed.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    filled = running_total(running_total(placed, "place", "cap", "cap_before"), "place", "weight", "weight_before")
    level = (
        filled.crossJoin(whole).withColumn("left", F.col("all_size") - F.col("cap_before")).withColumn("open", F.col("all_weight") - F.col("weight_before"))
    )
    fits = F.col("cap") * F.col("open") >= F.col("weight") * F.col("left")
    at = level.agg(F.min(F.when(fits, F.struct("place", "left", "open"))).alias("at"))
    share = (F.col("weight") * F.col("at.left")).cast("double") / F.col("at.open")
    return placed.crossJoin(at).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), share).alias("target")
    )


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            draw(F.col("doc_id"), F.col("text"), seed).alias("draw"),
        ),
        "mix-sizes",
    )


def _plan(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """(_source, source_size, target, whole, slice, rest), written: whole epochs, the slice of
    the seeded order in which the rest of the target ends, and how far into it."""
    plan = targets(sized.select("source", "size"), weights, max_epochs)
    wanted, filled = F.round("target").cast("long"), F.col("source_size") > 0
    plan = plan.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.when(filled, F.expr("cast(round(target) as long) div source_size")).otherwise(F.lit(0)).alias("whole"),
        F.when(filled, wanted % F.col("source_size")).otherwise(F.lit(0)).alias("part"),
    )
    slices = sized.groupBy(F.col("source").alias("_s"), _slice().alias("slice")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("_s").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_s").eqNullSafe(F.col("_source"))
    borders = (
        slices.withColumn("end", F.sum("words").over(upto)).join(plan, same)
        .where("end - words < part and end >= part")
        .select("_s", "slice", (F.col("part") - F.col("end") + F.col("words")).alias("rest"))
    )
    return written(
        plan.join(borders, same, "left").select(
            "_source", "source_size", "target", "whole",
            F.coalesce("slice", F.lit(-1)).cast("long").alias("slice"), F.coalesce("rest", F.lit(0)).alias("rest"),
        ),
        "mix-plan",
    )


def _slice() -> Column:
    return F.shiftright("draw", 60 - SLICE_BITS)


def _border(placed: DataFrame) -> DataFrame:
    """The rows of the slices in which a target ends, with ``more``: 1 if taken once more."""
    # Repeated rows share a hash; they stand as one row with a count until their order is settled.
    order = Window.partitionBy("_source").orderBy("draw", "doc_id", "size")
    before = F.coalesce(F.sum(F.col("size") * F.col("rows")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        placed.where("at = slice").groupBy(*placed.columns).agg(F.count("*").alias("rows"))
        .withColumn("_before", before)
        .withColumn("nth", F.explode(F.sequence(F.lit(0), (F.col("rows") - 1).cast("int"))))
        .withColumn("more", ((F.col("_before") + F.col("nth") * F.col("size")) * 2 + F.col("size") < F.col("rest") * 2).cast("long"))
        .drop("_before", "rows", "nth")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source.

    ``size`` is the number of words. Each document of a source is taken as many
    whole times as the target holds whole epochs; the rest of the target is
    filled with documents in a seeded order, by whole documents, to the nearest
    document border. ``taken`` is ``copies`` times ``size``.

    Null text has size 0 and is taken as often as the whole epochs say; null
    sources are one source; a null doc_id is ordered like a value. Repeated rows
    count as rows of their own. No documents give no rows. If all sizes are 0,
    targets are 0. The order is by hash of seed, doc_id and text, so reruns on
    any layout agree. Other columns are ignored.
    """
    sized = _sized(docs, seed)
    plan = _plan(sized, weights, max_epochs)
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("at", _slice())
    apart = placed.where("at <> slice").withColumn("more", (F.col("at") < F.col("slice")).cast("long"))
    copies = F.col("whole") + F.col("more")
    return apart.unionByName(_border(placed)).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.cast("int").alias("copies"), "source"
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with all their columns.

    One number per source, the last draw that is taken once more, carries the
    decision to the rows, so texts are not shuffled. Rows that repeat a doc_id
    and a text draw alike and go together.
    """
    sized = _sized(docs, seed)
    plan = _plan(sized, weights, max_epochs)
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("at", _slice())
    last = _border(placed).where("more = 1").groupBy(F.col("_source").alias("_s")).agg(F.max("draw").alias("last"))
    source, whole, cut, drawn, nth = free(docs, "_mix_source", "_mix_whole", "_mix_cut", "_mix_draw", "_mix_nth")
    cuts = written(
        plan.join(last, F.col("_source").eqNullSafe(F.col("_s")), "left").select(
            F.col("_source").alias(source), F.col("whole").alias(whole),
            F.coalesce("last", F.shiftleft("slice", 60 - SLICE_BITS) - 1).alias(cut),
        ),
        "mix-cuts",
    )
    marked = docs.withColumn(drawn, draw(F.col("doc_id").cast("long"), F.col("text"), seed))
    copies = F.col(whole) + (F.col(drawn) <= F.col(cut)).cast("long")
    return (
        marked.join(cuts, F.col("source").cast("string").eqNullSafe(F.col(source)))
        .where(copies > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), copies.cast("int")))).select(*docs.columns)
    )
