"""Product codes of vectors, trained and assigned by equal-average search.

A vector is cut into equal consecutive parts, each with its own codebook of at most ``ENTRIES`` entries of whole numbers. The
search sorts a codebook by the sum of components. From the place of a part's own sum it expands outwards; as the squared
gap of two sums over the dimension is a lower bound of the squared distance, a side ends when this bound strictly
exceeds the best distance so far (entries at the bound may still tie). Parts are taken in blocks of near sums, so that a step
is one product of matrices; a part leaves the block's expansion on its own. Sums and distances are whole numbers and exact.

Each round of training is one pass over the vectors: a task adds up its parts by entry and gives at most one row per entry, and Spark
adds these rows up. Nothing that grows with the vectors reaches the driver; a codebook has at most 4 x 256 entries.

Defined cases: rows whose vector is null, empty, holds a null or non-finite component or is not of the most common
dimension (the largest of several) take no part; where the dimension is no multiple of the parts, the first parts
are one component longer; rows without an id are coded after those with one and start no entry before them; rows that share
an id are taken in the order of their vectors; with fewer rows than entries the codebook has one entry per row; components beyond
2**40 after scaling are held there, errors beyond a long are its largest value, and a sum of them over a label is null; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 2.0**40
#: Parts of near sums that expand together, and entries looked at in one step.
BLOCK, STEP = 256, 16
ROWS = 4096

# ---------------------------------------------------------------- search


@dataclass
class Sorted:
    """A codebook in the order of its sums."""

    entries: np.ndarray  # by sum
    sums: np.ndarray
    index: np.ndarray  # place in the codebook

    @staticmethod
    def of(book: np.ndarray) -> Sorted:
        sums = book.sum(1)
        order = np.argsort(sums, kind="stable")
        return Sorted(book[order], sums[order], order.astype(np.int64))


def _kind(*arrays: np.ndarray) -> type:
    """Doubles where all distances, gaps and keys are exact in them and in longs, Python's whole numbers elsewhere."""
    top = max([int(np.abs(a).max()) for a in arrays if a.size], default=0)
    width = max(1, *(a.shape[-1] for a in arrays))
    return np.float64 if (2 * top * width) ** 2 < 1 << 53 else object


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per part the nearest entry (the lowest of several), its squared distance, and how many pairs were measured in all."""
    kind = _kind(parts, book)
    whole = np.int64 if kind is np.float64 else object
    sorted_ = Sorted.of(book.astype(kind))
    n, width = len(parts), parts.shape[1]
    own = parts.astype(kind)
    sums = own.sum(1)
    by_sum = np.argsort(sums, kind="stable")
    codes, errors, measured = np.zeros(n, np.int64), np.zeros(n, whole), 0
    entry_norms = (sorted_.entries * sorted_.entries).sum(1)
    total = len(book)
    for first in range(0, n, BLOCK):
        rows = by_sum[first : first + BLOCK]
        p, s = own[rows], sums[rows]
        norms = (p * p).sum(1)
        # One number orders by distance, then by place in the codebook.
        best = np.full(len(rows), -1, whole)

        def look(active: np.ndarray, low: int, high: int) -> None:
            some = norms[active][:, None] + entry_norms[low:high][None, :] - 2 * (p[active] @ sorted_.entries[low:high].T)
            key = (some.astype(whole) * total + sorted_.index[low:high][None, :]).min(1)
            known = best[active]
            best[active] = np.where((known < 0) | (key < known), key, known)

        low, high = (int(np.searchsorted(sorted_.sums, v)) for v in (s[0], s[-1]))
        low = max(0, min(low, total - 1))
        high = max(low + 1, min(total, high + 1))
        look(np.arange(len(rows)), low, high)
        measured += len(rows) * (high - low)
        while True:
            reach = (best // total) * width
            down = np.flatnonzero((s - sorted_.sums[low - 1]) ** 2 <= reach) if low else np.empty(0, int)
            if len(down):
                to = max(0, low - STEP)
                look(down, to, low)
                measured += len(down) * (low - to)
                low = to
                reach = (best // total) * width
            up = np.flatnonzero((sorted_.sums[high] - s) ** 2 <= reach) if high < total else np.empty(0, int)
            if len(up):
                to = min(total, high + STEP)
                look(up, high, to)
                measured += len(up) * (to - high)
                high = to
            if not len(down) and not len(up):
                break
        codes[rows], errors[rows] = (best % total).astype(np.int64), best // total
    return codes, errors, measured


# ---------------------------------------------------------------- vectors


def cuts(dimension: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where each part begins and ends."""
    ends = np.cumsum([dimension // parts + (i < dimension % parts) for i in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` where the vector has finite components only."""
    return df.filter(f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")


def common_dimension(df: DataFrame, vector: str = "embedding") -> int | None:
    top = df.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return top["n"] if top else None


def _whole_numbers(column, dimension: int) -> np.ndarray:
    """Rows of scaled components, rounded down."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(-1, dimension)


def _batches(batches: Iterator) -> Iterator:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


# ---------------------------------------------------------------- training and coding

Books = list[np.ndarray]


def first_books(rows: DataFrame, dimension: int, entries: int = ENTRIES) -> Books:
    """The parts of the rows with the smallest ids."""
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).toArrow()
    numbers = _whole_numbers(first.column("embedding").combine_chunks(), dimension)
    return [numbers[:, a:b] for a, b in cuts(dimension)]


def one_round(rows: DataFrame, books: Books, dimension: int) -> Books:
    """Each entry as the mean, rounded down, of the parts nearest to it; entries without any stay."""
    spans, width = cuts(dimension), max(b.shape[1] for b in books)

    def add_up(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in _batches(batches):
            numbers = _whole_numbers(batch.column("embedding"), dimension)
            for i, (a, b) in enumerate(spans):
                codes = nearest(numbers[:, a:b], books[i])[0]
                counts[i] += np.bincount(codes, minlength=len(books[i]))
                np.add.at(sums[i], codes, numbers[:, a:b])
        part, entry, n, total = [], [], [], []
        for i, c in enumerate(counts):
            used = np.flatnonzero(c)
            part += [i] * len(used)
            entry += used.tolist()
            n += c[used].tolist()
            total += [[*row, *[0] * (width - len(row))] for row in sums[i][used].tolist()]
        if part:
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
                ["part", "entry", "n", "total"],
            )

    added = rows.select("embedding").mapInArrow(add_up, "part int, entry int, n bigint, total array<bigint>")
    # Decimals, as sums over many tasks may leave a long.
    columns = [F.sum(F.col("total")[i].cast("decimal(19,0)")).alias(f"c{i}") for i in range(width)]
    found = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect()
    moved = [b.copy() for b in books]
    for r in found:
        book = moved[r["part"]]
        book[r["entry"]] = [int(r[f"c{i}"]) // r["n"] for i in range(book.shape[1])]
    return moved


def trained(rows: DataFrame, dimension: int, rounds: int = ROUNDS) -> Books:
    books = first_books(rows, dimension)
    for _ in range(rounds):
        books = one_round(rows, books, dimension)
    return books


def fingerprint(books: Books) -> str:
    """sha256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book.tolist() for c in entry).encode()).hexdigest()


def coded(rows: DataFrame, books: Books, dimension: int) -> DataFrame:
    """``vec_id``, ``label``, code and error of each row."""
    spans = cuts(dimension)
    largest = (1 << 63) - 1

    def code(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in _batches(batches):
            numbers = _whole_numbers(batch.column("embedding"), dimension)
            found = [nearest(numbers[:, a:b], book) for (a, b), book in zip(spans, books, strict=True)]
            codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
            errors = [min(sum(map(int, e)), largest) for e in zip(*(f[1].tolist() for f in found), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return rows.mapInArrow(code, rows.select("vec_id", "label").schema.add("code", "string").add("error", "long"))


def code_report(vectors: DataFrame) -> DataFrame:
    """Codes and errors of all usable rows of ``vectors(vec_id, embedding, label)`` by the trained codebooks."""
    rows = usable(vectors.select("vec_id", "embedding", "label"))
    dimension = common_dimension(rows)
    if dimension is None:
        return rows.selectExpr("vec_id", "'' as code", "0L as error", "0L as label_error", "'' as codebooks_sha256").filter("false")
    rows = rows.filter(F.size("embedding") == dimension)
    books = trained(rows, dimension)
    codes = stored(coded(rows, books, dimension), "vector-codes")
    # Written too, so that the join knows their size.
    sums = stored(codes.groupBy(F.col("label").alias("of_label")).agg(F.expr("try_sum(error)").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )
