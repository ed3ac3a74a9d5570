"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last 16 bytes meets a mask, so equal passages give equal chunks wherever
they stand. A chunk's identifier is a 128-bit digest, verified by its bytes: all distinct chunks are brought together
by identifier once, and should two different ones share it, all is done anew with another key. A text is then the
ordered list of its identifiers, its recipe; texts are equal exactly if their recipes are. Only recipes move from there on.

Of equal texts the row with the largest ``doc_id`` stays; of rows that share that too, one.

Defined cases: null counts as the empty text, whose recipe is empty; a null id is smaller than any other; very long texts
are many chunks; an empty table gives no rows; extra columns are kept by ``keep_distinct``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored, whole_text

MIN_CHUNK, MAX_CHUNK = 256, 8192
#: One position in 1024 is a possible cut.
MASK = 0x3FF << 6
WINDOW = 16
ID_BYTES = 16
SCHEMA = "doc_id bigint, row bigint, recipe binary, text_sha256 string, chunk binary, content binary"


def gear_table():
    """A fixed pseudo-random 32-bit word per byte."""
    import numpy as np

    words = [int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4).digest(), "little") for i in range(256)]
    return np.array(words, np.uint32)


def possible_cuts(data, gear):
    """Positions after which a chunk may end: the rolling hash over the last ``WINDOW`` bytes meets the mask."""
    import numpy as np

    h = gear[data]
    span = 1
    while span < WINDOW:
        # The hash of twice the span, from two neighbouring spans.
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return np.flatnonzero((h & np.uint32(MASK)) == 0) + 1


def chunk_ends(cuts: list[int], n: int) -> list[int]:
    """Ends of the chunks of a text of ``n`` bytes. Cuts nearer than ``MIN_CHUNK`` to the last are passed over."""
    ends, last = [], 0
    for cut in [*cuts, n]:
        while cut - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if cut - last >= MIN_CHUNK and n - cut >= MIN_CHUNK:
            last = cut
            ends.append(cut)
    return [*ends, n] if n > last else ends


def recipes(docs: DataFrame, key: bytes) -> DataFrame:
    """A row per document with its recipe, and a row per chunk that is new to its task with its content."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        gear, seen = gear_table(), set()
        row = TaskContext.get().partitionId() << 40
        types = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.binary(), pa.binary())
        names = ["doc_id", "row", "recipe", "text_sha256", "chunk", "content"]
        columns: list[list] = [[] for _ in names]
        held = 0

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            for c in columns:
                c.clear()
            return batch

        def add(*values):
            for c, v in zip(columns, values, strict=True):
                c.append(v)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or b""
                data = np.frombuffer(text, np.uint8)
                # The window must lie inside the text, and no chunk ends before MIN_CHUNK anyway.
                cuts = possible_cuts(data, gear).tolist() if len(text) >= 2 * MIN_CHUNK else []
                ids, start = [], 0
                for end in chunk_ends(cuts, len(text)):
                    content = text[start:end]
                    chunk = hashlib.blake2b(content, digest_size=ID_BYTES, key=key).digest()
                    ids.append(chunk)
                    if chunk not in seen:
                        seen.add(chunk)
                        held += len(content)
                        add(None, None, None, None, chunk, content)
                    start = end
                add(doc, row, b"".join(ids), hashlib.sha256(text).hexdigest(), None, None)
                row += 1
                if held > 4_000_000 or len(columns[0]) > 20_000:
                    yield flush()
                    held = 0
        if columns[0]:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(cut, SCHEMA)


def clashes(table: DataFrame) -> int:
    """Identifiers that more than one content has."""
    chunks = table.filter("chunk is not null").select("chunk", "content").repartition("chunk")
    distinct = chunks.groupBy("chunk", "content").agg(F.lit(1).alias("one"))
    return distinct.groupBy("chunk").agg(F.count("*").alias("n")).filter("n > 1").count()


def verified_recipes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``recipe``, ``text_sha256`` per document; equal recipes mean equal texts."""
    attempt = 0
    while True:
        table = stored(recipes(docs, b"chunk%d" % attempt), "chunks")
        if not clashes(table):
            return table.filter("row is not null").select("doc_id", "row", "recipe", "text_sha256")
        attempt += 1


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every document with the row that stays for its text, and whether it is that row."""
    rows = verified_recipes(docs)
    # Rows that share text and id are summed up first; the row breaks ties of the id.
    same = rows.groupBy("recipe", "doc_id").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    groups = same.groupBy("recipe").agg(
        F.sum("n").alias("n"), F.max("doc_id").alias("keep_id"), F.max(F.struct("doc_id", "row")).getField("row").alias("keep_row")
    )
    # Written, so that the join has rows of documents on one side only and a hot text's can be split.
    many = stored(groups.filter("n > 1").withColumnRenamed("recipe", "of"), "copies")
    found = rows.join(many, F.col("recipe") == F.col("of"), "left")
    return found.selectExpr(
        "doc_id", "case when of is null then doc_id else keep_id end as keep_id", "coalesce(n, 1L) as group_size",
        "of is null or row = keep_row as kept", "text_sha256",
    )


def keep_distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns, whatever their names.

    Joined are the ids of dropped rows, which are fewer than those that stay. Only where an id stands on rows
    of both kinds, or on several that stay, the text decides as well.
    """
    groups = stored(exact_groups(docs).select("doc_id", "text_sha256", "kept"), "exact-groups")
    by_id = groups.groupBy(F.col("doc_id").alias("id")).agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    dropped = stored(by_id.filter("not kept").select("id"), "exact-dropped")
    mixed = stored(by_id.filter("kept and rows > 1").select("id"), "exact-mixed")
    d, x, k = (F.col(f"{side}.id") for side in ("gone", "mixed", "keys"))
    # Rows go as one struct, so that no column of theirs meets one of these names.
    rows = docs.select(F.struct("*").alias("own")).alias("docs")
    own_id = F.col("docs.own.doc_id").cast("bigint")
    rest = rows.join(dropped.alias("gone"), own_id.eqNullSafe(d), "left_anti")
    if mixed.isEmpty():
        return rest.select("own.*")
    keys = groups.filter("kept").select(F.col("doc_id").alias("id"), "text_sha256").distinct().alias("keys")
    match = own_id.eqNullSafe(k) & (F.sha2(whole_text("docs.own.text"), 256) == F.col("keys.text_sha256"))
    is_mixed = own_id.eqNullSafe(x)
    several = rest.join(mixed.alias("mixed"), is_mixed, "left_semi").join(keys, match, "left_semi")
    # Rows repeated with id and text are told apart by nothing that counts.
    once = several.select("own", F.col("own.doc_id").alias("id"), whole_text("own.text").alias("text")).dropDuplicates(["id", "text"])
    return rest.join(mixed.alias("mixed"), is_mixed, "left_anti").select("own").unionByName(once.select("own")).select("own.*")
