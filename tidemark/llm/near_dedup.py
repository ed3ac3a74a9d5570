"""Near duplicates by SuperMinHash signatures, banding, verification on full shingle sets and union-find.

In a SuperMinHash signature each element draws a random permutation of the slots and gives its j-th slot the value j
plus a random fraction; a slot keeps its least value. The slots' ranks are so correlated that every slot is filled, which
lowers the variance. Here all elements of all texts of a batch go through level j at once, and a text stops at the
level at which all its slots are filled: later levels could only bring larger values.

Texts with equal shingle sets form one class, and everything from there on works on one representative each. With 32
bands of 4 slots, a pair of similarity 0.75 misses all bands with probability 5e-6. Within a band's bucket pairs are not
listed: every member is compared to the bucket's first one, then, where several components are left in a bucket, to a few
more. Links form components. Members of buckets that still hold several components are joined across components by
the rarest shingles of their sets: two sets of similarity 0.75 share one among the rarest quarter of each, at a place
that leaves room for enough others. That join is exact, so no link that would join two components is lost, and it meets
almost no other pairs, however many texts share a common passage. Star comparisons skip pairs whose signatures agree in
far fewer slots than 0.75 allows.

Defined cases: null and empty texts and texts without words have no set, are linked with nothing and stay; a null id is
never the smallest; repeated rows are one class; an empty table gives no rows; very long texts are sets like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import stored
from tidemark.llm.components import connected_components

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
WORDS = 5
PERCENT = 75
#: Members of a bucket with several components that its others are compared to.
PIVOTS = 4
#: Slots (of 128) that must agree: 0.75 less more than four standard deviations of the estimate.
AGREE = 76
SIGNED = "doc_id bigint, text_key bigint, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary"


def super_minhash(elements, owner, n_sets: int, slots: int = SLOTS):
    """Signatures (sets x slots) of the sets whose elements are ``elements``; ``owner`` is each one's set."""
    import numpy as np

    from tidemark.llm.wordhash import BASE, mix

    unset = np.uint64(2**64 - 1)
    least = np.full((n_sets, slots), unset, np.uint64)
    flat = least.reshape(-1)
    drawn: list = []  # per level: the position that was swapped to, and what came to stand there
    for level in range(slots):
        x = mix(elements + np.uint64((level + 1) * BASE & (2**64 - 1)))
        at = level + ((x >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        slot, moved = at.copy(), np.full(len(x), level, np.int64)
        for earlier_at, earlier_moved in drawn:
            slot = np.where(earlier_at == at, earlier_moved, slot)
            moved = np.where(earlier_at == level, earlier_moved, moved)
        np.minimum.at(flat, owner * slots + slot, np.uint64(level << 32) | (x & np.uint64(0xFFFFFFFF)))
        unfilled = (least == unset).any(axis=1)
        active = unfilled[owner]
        if not active.any():
            break
        drawn.append((at, moved))
        if not active.all():
            elements, owner = elements[active], owner[active]
            drawn = [(a[active], m[active]) for a, m in drawn]
    return least


def _band_hashes(signatures):
    import numpy as np

    from tidemark.llm.wordhash import BASE, mix

    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(BASE)
    for r in range(ROWS):
        total = mix(total ^ parts[:, :, r])
    return total.view(np.int64)


def _text_key() -> Column:
    return F.xxhash64("doc_id", "text")


def signed(docs: DataFrame) -> DataFrame:
    """Size and digest of every document's shingle set, its band hashes and a byte of each slot."""

    def sign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from tidemark.llm import wordhash as wh

        for part, data, ends in wh.text_batches(batches):
            words, counts = wh.word_hashes(data, ends)
            sets = wh.shingles(words, counts, WORDS)
            sizes = np.array([len(s) for s in sets], np.int64)
            signatures = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
            bands = _band_hashes(signatures)
            lists = pa.ListArray.from_arrays(np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32), pa.array(bands.reshape(-1)))
            sketches = (signatures & np.uint64(0xFF)).astype(np.uint8)
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sizes), pa.array(ids, pa.binary()), lists,
                 pa.array([s.tobytes() for s in sketches], pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_id", "bands", "sketch"],
            )

    return _texts(docs).mapInArrow(sign, SIGNED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), F.col("text").cast("string").alias("text")
    )


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and sorted ``elements`` of the wanted representatives (``text_key``, ``set_id``, ``node``)."""
    keys = wanted.select(F.col("text_key").alias("wanted_key"), "set_id", "node")
    chosen = _texts(docs).join(keys, F.col("text_key") == F.col("wanted_key")).select("node", "set_id", "text")

    def sets(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from tidemark.llm import wordhash as wh

        for part, data, ends in wh.text_batches(batches):
            found = wh.shingles(*wh.word_hashes(data, ends), WORDS)
            digests = part.column("set_id").to_pylist()
            right = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(found, digests, strict=True)]
            found = [s for s, r in zip(found, right, strict=True) if r]
            offsets = np.append(0, np.cumsum([len(s) for s in found])).astype(np.int32)
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            nodes = part.column("node").filter(pa.array(right))
            yield pa.RecordBatch.from_arrays([nodes, pa.ListArray.from_arrays(offsets, pa.array(flat))], ["node", "elements"])

    rows = chosen.mapInArrow(sets, "node bigint, elements array<bigint>")
    return rows.dropDuplicates(["node"])


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in at least ``AGREE`` slots."""
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(reps.select(F.col("node").alias(f"{side}_node"), F.col("sketch").alias(f"{side}_sketch")), F.col(side) == F.col(f"{side}_node"))

    def agree(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            both = [np.frombuffer(b"".join(batch.column(f"{s}_sketch").to_pylist()), np.uint8).reshape(-1, SLOTS) for s in "ab"]
            yield batch.select(["a", "b"]).filter((both[0] == both[1]).sum(axis=1) >= AGREE)

    return sides.select("a", "b", "a_sketch", "b_sketch").mapInArrow(agree, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with ``100 * intersection >= 75 * union`` on full sets."""
    left = sets.select(F.col("node").alias("a_node"), F.col("elements").alias("a_set"))
    right = sets.select(F.col("node").alias("b_node"), F.col("elements").alias("b_set"))
    both = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
    counted = both.select("a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("shared"), (F.size("a_set") + F.size("b_set")).alias("sum"))
    return counted.filter(f"100 * shared >= {PERCENT} * (sum - shared)").select("a", "b")


def _sizes_allow(x: str, y: str) -> Column:
    return F.expr(f"100 * least({x}, {y}) >= {PERCENT} * greatest({x}, {y})")


def near_links(docs: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Representatives ``reps`` (``set_id`` to ``node``) and the components ``(node, component)`` of those with links."""
    classes = table.filter("set_id is not null").groupBy("set_id").agg(
        F.min("text_key").alias("text_key"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch"),
    )
    reps = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    entries = reps.select("node", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("first")).filter("members > 1")
    members = stored(
        entries.join(shared.withColumnRenamed("bucket", "of"), F.col("bucket") == F.col("of")).drop("of"), "buckets"
    )
    wanted = members.select(F.col("node").alias("member")).distinct()
    sets = stored(_full_sets(docs, reps.join(wanted, F.col("node") == F.col("member"))), "shingle-sets")
    # A group of near copies shares its first member, so nothing but the join below stands on that key: it can be split.
    pairs = members.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    tested = stored(_agreeing(pairs, reps), "near-pairs")
    links = stored(_confirmed(tested, sets), "near-links")
    open_ = _open_members(members, links)
    chosen = open_.filter(F.pmod(F.xxhash64("node"), F.col("members")) < PIVOTS)
    other = chosen.selectExpr("bucket as of", "node as pivot", "n as pivot_n", "component as pivot_component")
    across = open_.join(other, (F.col("bucket") == F.col("of")) & (F.col("component") != F.col("pivot_component")) & _sizes_allow("n", "pivot_n"))
    pairs = across.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    more = stored(_agreeing(pairs.join(tested, ["a", "b"], "left_anti"), reps), "near-pairs")
    links = links.unionByName(stored(_confirmed(more, sets), "near-links"))
    left = _open_members(members, links).select("node", "n", "component").distinct()
    links = links.unionByName(stored(_confirmed(_prefix_pairs(left, sets), sets), "near-links"))
    return reps, connected_components(links)


def _open_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, each with its ``component``."""
    labels = connected_components(links).select(F.col("node").alias("of"), "component")
    named = members.join(labels, F.col("node") == F.col("of"), "left").withColumn("component", F.coalesce("component", "node")).drop("of", "first")
    split = named.groupBy(F.col("bucket").alias("of")).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return stored(named.join(split, F.col("bucket") == F.col("of")).select("bucket", "node", "n", "component", "members"), "open-buckets")


def _prefix_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs across components of ``nodes(node, n, component)`` that may reach the similarity, by their rarest shingles."""
    elements = sets.select(F.col("node").alias("of"), F.explode("elements").alias("element"))
    held = stored(nodes.join(elements, F.col("node") == F.col("of")).drop("of"), "open-shingles")
    shared = held.groupBy(F.col("element").alias("seen")).agg(F.count("*").alias("times")).filter("times > 1")
    counted = held.join(shared, F.col("element") == F.col("seen"), "left").withColumn("times", F.coalesce("times", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "element"))
    first = counted.withColumn("place", place).filter(f"place <= n - ceil({PERCENT} * n / 100) + 1 and times > 1")
    first = stored(first.select("element", "node", "n", "component", "place"), "rare-shingles")
    right = first.selectExpr("element as seen", "node as other", "n as other_n", "component as other_component", "place as other_place")
    # Up to its first common shingle a pair has nothing in common, after it at most what is left of the shorter rest.
    room = "1 + least(n - place, other_n - other_place)"
    enough = f"{100 + PERCENT} * ({room}) >= {PERCENT} * (n + other_n)"
    met = first.join(right, F.expr(f"element = seen and node < other and component <> other_component and {enough}"))
    return met.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()


def _placed(docs: DataFrame, order: Column) -> DataFrame:
    """Rows of every document (``doc_id``, ``text_key``, ``n_shingles``, ``set_id``) with the least ``order`` of its component, ``first``."""
    table = stored(signed(docs), "signatures")
    reps, labels = near_links(docs, table)
    classes = table.groupBy("set_id").agg(F.min(order).alias("class_first")).filter("set_id is not null")
    named = (
        reps.select("set_id", "node").join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .select(F.col("set_id"), F.coalesce("component", "node").alias("component")).join(classes, "set_id")
    )
    named = stored(named, "class-components")
    first = named.groupBy("component").agg(F.min("class_first").alias("first"))
    by_set = named.join(first.withColumnRenamed("component", "of"), F.col("component") == F.col("of")).select(F.col("set_id").alias("of_set"), "first")
    rows = table.select("doc_id", "text_key", "n_shingles", "set_id")
    return rows.join(by_set, F.col("set_id") == F.col("of_set"), "left").drop("of_set")


def near_components(docs: DataFrame) -> DataFrame:
    """Every document with the size of its shingle set, its component and whether it stays."""
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    found = _placed(docs, F.col("doc_id")).select("doc_id", "n_shingles", own.alias("component_id"))
    return found.withColumn("kept", F.expr("doc_id <=> component_id"))


def keep_distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names: one of each component, and all that are
    linked with nothing for want of words.

    Of a component the row with the least id stays, among equal or null ids that of the least text key. Joined are the
    rows that go, which are fewer, by id and text key, as an id may stand on rows of both kinds.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("text_key").alias("text"))
    placed = _placed(docs, order).filter("set_id is not null")
    placed = stored(placed.select("doc_id", "text_key", order.eqNullSafe(F.col("first")).alias("stays")), "near-rows")
    dropped = stored(placed.filter("not stays").select("doc_id", "text_key").distinct(), "near-dropped")
    again = placed.filter("stays").groupBy("doc_id", "text_key").count()
    again = stored(again.filter("count > 1").drop("count"), "near-repeated")
    # Rows go as one struct, so that no column of theirs meets one of these names.
    rows = docs.select(F.struct("*").alias("own"), F.col("doc_id").cast("bigint").alias("own_id"), _text_key().alias("own_key"))

    def same(of: str) -> Column:
        return F.col("own_id").eqNullSafe(F.col(f"{of}.doc_id")) & (F.col("own_key") == F.col(f"{of}.text_key"))

    rest = rows.join(dropped.alias("gone"), same("gone"), "left_anti")
    if again.isEmpty():
        return rest.select("own.*")
    # Rows repeated with id and text are told apart by nothing that counts.
    once = rest.join(again.alias("twice"), same("twice"), "left_semi").dropDuplicates(["own_id", "own_key"])
    return rest.join(again.alias("twice"), same("twice"), "left_anti").select("own").unionByName(once.select("own")).select("own.*")
