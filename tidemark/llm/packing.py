"""Best-fit packing of documents into token sequences by hierarchical residuals.

Every task packs its own pieces, longest first, each into the open sequence with the least room that holds it.
Nearly full sequences are final. The underfull ones become items themselves and meet in fewer tasks, level by level,
where they are packed as wholes in the same way. Tasks work through bounded groups of rows, so a level never
gathers more than ``TASK_ITEMS`` items in one task; the levels end when one task is left or a level no longer helps.

Defined cases: null text counts as empty and gives one piece, the end id; repeated rows are packed each;
a null id is an ordinary id; an empty table gives no rows; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.base import stored

CAPACITY = 2048
END_ID = 0
#: A sequence with at most this much room is final.
NEARLY_FULL = 4
TASK_ITEMS = 400_000
FAN_IN = 8
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECE}, bin bigint, at bigint, fill bigint"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document's pieces; only the first of a longer one may be short."""
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, flat, counts in tokens.encoded(batches, vocabulary, end_id):
            columns: list[list] = [[], [], [], [], []]
            data, at = memoryview(flat.astype("<u4", copy=False)).cast("B"), 0
            for doc, n in zip(part.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                stops = range(n - (n - 1) // capacity * capacity, n + 1, capacity)
                start = 0
                for k, stop in enumerate(stops):
                    crc = zlib.crc32(data[tokens.ID_BYTES * (at + start) : tokens.ID_BYTES * (at + stop)])
                    for column, value in zip(columns, (doc, k, start, stop - start, crc), strict=True):
                        column.append(value)
                    start = stop
                at += n
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECE)


def best_fit(fills, capacity: int):
    """Bin of each item and its place there. Longest first, each into the bin with the least room that holds it."""
    import numpy as np

    order = np.argsort(-fills, kind="stable")
    bins, at = np.empty(len(fills), np.int64), np.empty(len(fills), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # bit r of rooms: some bin has room r
    for i, size in zip(order.tolist(), fills[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            b, room, n = n, capacity, n + 1
        bins[i], at[i] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, at


def _pack_level(rows: DataFrame, level: int, capacity: int) -> DataFrame:
    """Packs the bins of each task's rows (a bin's rows stand together) into new ones."""
    limit = TASK_ITEMS

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        first = (level << 58) | (TaskContext.get().partitionId() << 34)
        made = 0

        def packed(table):
            nonlocal made
            old = table.column("bin").to_numpy()
            head = np.append(True, old[1:] != old[:-1])
            item = np.cumsum(head) - 1
            fills = table.column("fill").to_numpy()[head]
            bins, at = best_fit(fills, capacity)
            n = int(bins.max()) + 1
            total = np.bincount(bins, weights=fills, minlength=n).astype(np.int64)
            columns = {
                "bin": first + made + bins[item], "at": table.column("at").to_numpy() + at[item], "fill": total[bins[item]],
            }
            made += n
            for name, values in columns.items():
                table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
            return table.combine_chunks().to_batches()

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= limit:
                table = pa.Table.from_batches(held).combine_chunks()
                bins = table.column("bin").to_numpy()
                others = np.flatnonzero(bins != bins[-1])
                whole = int(others[-1]) + 1 if len(others) else 0  # the last bin may go on in the next batch
                if whole:
                    yield from packed(table.slice(0, whole))
                held, n = table.slice(whole).to_batches(), n - whole
        if n:
            yield from packed(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(pack, PACKED)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and place of every row of ``cut`` (stored pieces)."""
    numbered = cut.withColumn("bin", F.monotonically_increasing_id()).selectExpr("*", "0L as at", "length as fill")
    full = numbered.filter(F.col("length") == capacity).withColumn("bin", F.expr(f"bin | {1 << 62}"))
    rows, done = numbered.filter(F.col("length") < capacity), [full]
    parts, before = None, None
    for level in range(1, 15):
        packed = stored(_pack_level(rows, level, capacity), "packed")
        open_ = packed.filter(F.col("fill") < capacity - NEARLY_FULL)
        done.append(packed.filter(F.col("fill") >= capacity - NEARLY_FULL))
        n_rows, n_bins, n_tasks = open_.agg(
            F.count("*"), F.count_distinct("bin"), F.count_distinct(F.shiftright("bin", 34))
        ).first()
        ended = parts == 1 or (before is not None and n_bins > 0.98 * before and parts <= -(-n_rows // TASK_ITEMS))
        if n_bins < 2 or ended:
            done.append(open_)
            break
        parts, before = max(1, -(-n_rows // TASK_ITEMS), (parts or n_tasks) // FAN_IN), n_bins
        rows = open_.repartition(parts, "bin").sortWithinPartitions("bin")
    else:
        done.append(open_)
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "bin as sequence_id", "at as offset"
    )


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    cut = stored(pieces(docs, vocabulary or tokens.vocabulary_path(), capacity), "pieces")
    return pack(cut, capacity)
