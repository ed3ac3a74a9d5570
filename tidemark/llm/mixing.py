"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Each source's target is its weight's share of the budget, but at most ``max_epochs`` times its own size; what
clamping frees is shared again by weight among the rest, until no target is above its cap. A source with target
``e`` times its size repeats every document ``floor(e)`` times, and the fraction that is left is filled with a
seeded sample: documents in the order of a seeded hash, until the words are used up.

The sample needs no sort of a source. Documents fall into 256 buckets by the first byte of their hash and the
bucket where the fraction ends into 256 more by the second, so only sums per bucket and the few rows of one
bucket in 65,536 are ordered; a source may hold any share of all rows.

Defined cases: null text has size 0 and is never taken; null sources form one source, ordered last; repeated rows
count each; an empty table gives an empty result; extra columns are kept by ``with_copies`` under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import stored

WORD = r"[^\x20\x09-\x0D]+"
SEED = 17
MAX_EPOCHS = 3


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, words (``mix_size``) and seeded order (``mix_order``) of every row."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), *_keys(seed))


def _keys(seed: int) -> list[Column]:
    return [n_words().alias("mix_size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("mix_order")]


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1 to ``cycle``, repeating, by code point order of the names, null last. One row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    rank = F.row_number().over(order) - 1
    return sources.withColumn("weight", (rank % cycle + 1).cast("double"))


def source_sizes(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("source").agg(F.sum("mix_size").alias("source_size"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``source``, ``source_size``, ``weight``; the budget is the sum of all sizes.

    Each round is one aggregation over the sources: with level L, those whose ``L * weight`` reaches the cap are
    clamped, and the next L shares the rest of the budget over the others' weights. L only grows, so a round that
    clamps nothing new is the last.
    """
    cap = F.col("source_size") * max_epochs
    clamped, level = -1, 0.0
    while True:
        over = F.lit(level) * F.col("weight") >= cap
        total, taken, free, n = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count(F.when(over, 1)),
        ).first()
        if n == clamped or not free:
            break
        clamped, level = n, (total - taken) / free
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _edge(rows: DataFrame, plan: DataFrame, byte: int, keys: list[str]) -> DataFrame:
    """The bucket of ``mix_order``'s given byte in which each source's fraction ends, and the words before it."""
    bucket = f"edge{byte}"
    sums = rows.groupBy("source", *keys, _byte(byte).alias(bucket)).agg(F.sum("mix_size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy(bucket)) - F.col("words")
    found = (
        sums.withColumn("before", before).join(plan.select(F.col("source").alias("plan_source"), "need"),
                                               F.col("source").eqNullSafe(F.col("plan_source")))
        .filter("before < need and need <= before + words")
    )
    return found.select(F.col("source").alias("edge_source"), bucket, F.col("before").alias(f"before{byte}"))


def _byte(k: int) -> Column:
    return F.shiftrightunsigned("mix_order", 56 - 8 * k).bitwiseAND(F.lit(255))


def mixing_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: how often all its documents repeat, and where in the seeded order the fraction ends."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = stored(
        targets.withColumn("whole", whole.cast("int"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "mix-need",
    )
    first = stored(_edge(sizes, plan, 0, []), "mix-edge")
    rest = sizes.join(first, F.col("source").eqNullSafe(F.col("edge_source")) & (_byte(0) == F.col("edge0")))
    needs = plan.join(first, F.col("source").eqNullSafe(F.col("edge_source"))).withColumn("need", F.expr("need - before0"))
    second = _edge(rest.select("source", "mix_size", "mix_order"), needs, 1, [])
    edges = first.join(second.withColumnRenamed("edge_source", "second_source"),
                       F.col("edge_source").eqNullSafe(F.col("second_source")), "left").drop("second_source")
    joined = plan.join(edges, F.col("source").eqNullSafe(F.col("edge_source")), "left")
    return stored(joined.drop("edge_source").withColumnRenamed("source", "plan_source"), "mix-plan")


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with ``source``, ``mix_size``, ``mix_order``) plus the plan's columns and ``copies`` per row."""
    planned = rows.join(plan, F.col("source").cast("string").eqNullSafe(F.col("plan_source")))
    at_edge = F.expr("mix_size > 0 and need > 0") & (_byte(0) == F.col("edge0")) & (_byte(1) == F.col("edge1"))
    at_edge = F.coalesce(at_edge, F.lit(False))
    inside = (_byte(0) < F.col("edge0")) | ((_byte(0) == F.col("edge0")) & (_byte(1) < F.col("edge1")))
    plain = planned.filter(~at_edge).withColumn("extra", F.coalesce(inside & F.expr("need > 0"), F.lit(False)))
    order = Window.partitionBy("plan_source").orderBy("mix_order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("mix_size").over(order)
    # The row on the edge is taken if that brings the source nearer to its target.
    edge = planned.filter(at_edge).withColumn("extra", F.expr("before0 + before1") + upto - F.col("mix_size") / 2 < F.col("need"))
    copies = F.when(F.col("mix_size") > 0, F.col("whole") + F.col("extra").cast("int")).otherwise(0)
    return plain.unionByName(edge).withColumn("copies", copies)


def plan_for(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS, cycle: int = 3) -> tuple[DataFrame, DataFrame]:
    """The stored sizes of ``docs``, and the plan that mixes its sources with cyclic weights."""
    sizes = stored(sized(docs, seed), "mix-sizes")
    sources = stored(cyclic_weights(source_sizes(sizes), cycle), "mix-sources")
    return sizes, mixing_plan(sizes, water_fill(sources, max_epochs))


def mix_report(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per row of ``docs``: its size, its source's size and target, and the words the mix takes of it."""
    sizes, plan = plan_for(docs, seed, max_epochs)
    return with_copies(sizes, plan).selectExpr(
        "doc_id", "mix_size as size", "source_size", "target", "mix_size * copies as taken"
    )


def mix(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed rows of ``docs``, each as often as the mix takes it. Texts are not shuffled."""
    _, plan = plan_for(docs, seed, max_epochs)
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", "source", *_keys(seed))
    repeated = with_copies(keyed, plan).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
