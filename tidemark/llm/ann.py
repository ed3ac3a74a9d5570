"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample and kept balanced by splitting crowded ones. Every vector is listed under its
nearest centroid and, near a boundary, under others whose distance is within a ratio of the nearest. A query walks a neighbour graph over the
centroids, held in memory by each task, and reads the lists whose centroid is within a ratio of the nearest one's distance. Distances within
lists are exact.

The ratio is measured in each run: the neighbours of a few sampled queries are found by brute force over all vectors, and it is the
least at which ``RECALL`` of these neighbours stand in lists that are read. Where a query's nearest centroid is closer than that of most
sampled queries, their tenth percentile counts instead, as a multiple of nothing would be nothing. The walk keeps more centroids until the last
one it keeps is beyond the ratio.

Equal vectors are indexed once, with their smallest ids: no more of them than a query returns can appear in its
answer. Long lists are cut into segments and many queries of a list into blocks, so no task gathers an unbounded list.

Sizes: ``SAMPLE_PER_LIST`` rows per list are sampled for the fit, and there are at most ``MAX_LISTS`` lists, so the
driver sees at most 131,072 vectors and the graph has at most 8,192 nodes; every row is indexed.

Defined cases: vectors that are null, zero, of a rare dimension or hold null or non-finite components, and rows without an
id, take no part; a query with fewer candidates than asked for returns all; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import stored

NEIGHBOURS = 10
LIST_VECTORS = 120
MAX_LISTS, SAMPLE_PER_LIST = 8192, 16
REPLICAS, REPLICA_RATIO = 6, 1.25
#: Recall on the calibrating queries that the ratio is chosen for, and their number.
RECALL, CALIBRATING = 0.99, 128
#: Links of a centroid to its nearest ones and to chance ones, which keep the graph in one piece; centroids a walk keeps at first.
DEGREE, CHANCE, BEAM = 24, 4, 64
SEGMENT, BLOCK = 4000, 500

# ---------------------------------------------------------------- centroids and their graph


def squared_distances(a, b):
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def balanced_centroids(sample, k: int, rounds: int = 10, seed: int = 3):
    """At most ``k`` centroids by Lloyd steps; each step moves the emptiest ones into the most crowded clusters."""
    order = np.random.default_rng(seed)
    points = np.unique(sample, axis=0)
    k = max(1, min(k, len(points)))
    centres = points[order.choice(len(points), k, replace=False)].astype(np.float64)
    for step in range(rounds):
        near = np.concatenate([squared_distances(p, centres).argmin(1) for p in np.array_split(points, max(1, len(points) * k // 4_000_000 + 1))])
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        if step < rounds - 3:
            crowded = [c for c in np.argsort(-counts) if counts[c] > 2 * len(points) / k]
            empty = [c for c in np.argsort(counts)[: len(crowded)] if counts[c] < len(points) / k / 2]
            for c, e in zip(crowded, empty):
                centres[e] = points[order.choice(np.flatnonzero(near == c))]
    return centres


@dataclass
class Graph:
    centres: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @staticmethod
    def over(centres) -> Graph:
        degree = min(DEGREE, max(1, len(centres) - 1))
        links = []
        for part in np.array_split(np.arange(len(centres)), len(centres) // 1024 + 1):
            d = squared_distances(centres[part], centres)
            d[np.arange(len(part)), part] = np.inf
            links.append(np.argsort(d, axis=1, kind="stable")[:, :degree])
        chance = np.random.default_rng(7).integers(0, len(centres), (len(centres), CHANCE))
        every = np.sort(np.concatenate([np.concatenate(links) % len(centres), chance], 1), axis=1)
        # A link that is there twice leads to the centroid itself, which a walk has seen.
        again = np.pad(every[:, 1:] == every[:, :-1], ((0, 0), (1, 0)))
        every = np.where(again, np.arange(len(centres))[:, None], every)
        step = max(1, len(centres) // 16)
        return Graph(centres, every, np.arange(0, len(centres), step)[:16])

    def search(self, queries, beam: int = BEAM):
        """Ids and distances of about the ``beam`` nearest centroids of each query, nearest first."""
        n, k = len(queries), len(self.centres)
        beam = min(beam, k)
        rows = np.arange(n)[:, None]
        ids = np.repeat(self.entries[None, :], n, 0)
        seen = np.zeros((n, k), bool)
        seen[rows, ids] = True
        dist = np.sqrt(((queries[:, None, :] - self.centres[ids]) ** 2).sum(2))
        expanded = np.zeros(ids.shape, bool)
        while True:
            waiting = np.where(expanded, np.inf, dist)
            best = waiting.argmin(1)
            if not np.isfinite(waiting[rows[:, 0], best]).any():
                break
            going = np.isfinite(waiting[rows[:, 0], best])
            expanded[rows[:, 0], best] = True
            new = self.links[ids[rows[:, 0], best]]
            fresh = ~seen[rows, new] & going[:, None]
            seen[rows, new] |= going[:, None]
            far = np.sqrt(((queries[:, None, :] - self.centres[new]) ** 2).sum(2))
            far[~fresh] = np.inf
            ids, dist = np.concatenate([ids, new], 1), np.concatenate([dist, far], 1)
            expanded = np.concatenate([expanded, ~fresh], 1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, expanded = ids[rows, keep], dist[rows, keep], expanded[rows, keep]
        return ids, dist


# ---------------------------------------------------------------- index


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part."""
    rows = vectors.filter("vec_id is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    sound = rows.filter(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = sound.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return sound.filter(F.size("embedding") == (sizes[0]["n"] if sizes else 0))


def classes(rows: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Distinct vectors with their ``k + 1`` smallest ids. Tasks prune to these before anything is shuffled."""
    order = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.distinct().withColumn("nth", order).filter(F.col("nth") <= k + 1)
    grouped = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.withColumn("class", F.monotonically_increasing_id())


def _arrays(column) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def fit(indexed: DataFrame) -> Graph | None:
    n = indexed.count()
    if not n:
        return None
    k = int(min(MAX_LISTS, max(1, n // LIST_VECTORS)))
    sample = indexed.orderBy(F.xxhash64("embedding")).limit(k * SAMPLE_PER_LIST).select("embedding").toArrow()
    return Graph.over(balanced_centroids(_arrays(sample.column(0).combine_chunks()), k))


def postings(indexed: DataFrame, graph: Graph) -> DataFrame:
    """``list``, ``class``, ``first_id``, ``embedding``: every vector in its nearest list and in those it borders on."""
    centres = graph.centres

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                d = squared_distances(_arrays(batch.column("embedding")), centres)
                near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
                far = np.take_along_axis(d, near, axis=1)
                row, place = np.nonzero(far <= far[:, :1] * REPLICA_RATIO**2)
                lists = near[row, place]
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), *(taken.column(c) for c in ("class", "first_id", "embedding"))],
                    ["list", "class", "first_id", "embedding"],
                )

    slim = indexed.select("class", F.get("ids", F.lit(0)).alias("first_id"), "embedding")
    return slim.mapInArrow(assign, "list int, class bigint, first_id bigint, embedding array<double>")


# ---------------------------------------------------------------- search


@dataclass
class Reach:
    """Lists are read up to ``ratio`` times the distance of the nearest centroid, which counts as ``least`` at least, and on to ``room`` entries."""

    ratio: float
    least: float
    sizes: np.ndarray  # entries of each list
    room: int

    def lists(self, graph: Graph, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``points``, the lists that each reads, and whether a list is among the first, which together hold ``room`` entries.

        A walk that may have ended too early is walked anew with more room.
        """
        rows, lists, firsts, left, beam = [], [], [], np.arange(len(points)), BEAM
        while len(left):
            ids, dist = graph.search(points[left], beam)
            limits = self.ratio * np.maximum(dist[:, :1], self.least)
            before = np.cumsum(self.sizes[ids], axis=1) - self.sizes[ids]
            read = (dist <= limits) | (before < self.room)
            done = ~read[:, -1] | (beam >= len(graph.centres))
            row, place = np.nonzero(read & np.isfinite(dist) & done[:, None])
            rows.append(left[row])
            lists.append(ids[row, place])
            firsts.append(before[row, place] < self.room)
            left, beam = left[~done], 2 * beam
        return np.concatenate([np.empty(0, int), *rows]), np.concatenate([np.empty(0, int), *lists]), np.concatenate([np.empty(0, bool), *firsts])


def true_neighbours(indexed: DataFrame, asking: np.ndarray, points: np.ndarray, k: int) -> DataFrame:
    """``asking`` and ``near``, the ``k`` nearest classes by brute force over all vectors, for a few queries."""

    def nearest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        near, score = np.empty((len(points), 0), np.int64), np.empty((len(points), 0))
        for whole in batches:
            for start in range(0, whole.num_rows, 4000):
                batch = whole.slice(start, 4000)
                own = np.broadcast_to(np.asarray(batch.column("class")), (len(points), batch.num_rows))
                d = squared_distances(points, _arrays(batch.column("embedding")))
                d[own == asking[:, None]] = np.inf
                near, score = np.concatenate([near, own], 1), np.concatenate([score, d], 1)
                best = np.argsort(score, axis=1, kind="stable")[:, :k]
                near, score = np.take_along_axis(near, best, axis=1), np.take_along_axis(score, best, axis=1)
        # One row per query and task.
        found = [[{"score": s, "near": c} for s, c in zip(*row, strict=True) if s < np.inf] for row in zip(score.tolist(), near.tolist(), strict=True)]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("near", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(asking, pa.int64()), pa.array(found, kind)], ["asking", "found"])

    parts = indexed.select("class", "embedding").mapInArrow(nearest, "asking bigint, found array<struct<score:double,near:bigint>>")
    best = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k)
    return parts.groupBy("asking").agg(best.alias("found")).select("asking", F.explode("found.near").alias("near"))


def calibrated(indexed: DataFrame, lists: DataFrame, asked: DataFrame, graph: Graph, k: int) -> Reach:
    """The least ratio at which ``RECALL`` of the true neighbours of a bounded sample of queries stand in lists that are read."""
    sizes = np.zeros(len(graph.centres), np.int64)
    for r in lists.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    # A vector is in REPLICAS lists at most, so that many entries hold enough different ones to answer with.
    room = REPLICAS * (k + 1)
    sample = asked.orderBy(F.xxhash64("embedding")).limit(CALIBRATING).select("class", "embedding").toArrow()
    if not sample.num_rows:
        return Reach(1.0, 0.0, sizes, room)
    asking, points = sample.column("class").to_numpy(), _arrays(sample.column("embedding").combine_chunks())
    true = true_neighbours(indexed, asking, points, k)
    held = lists.select("class", "list").join(F.broadcast(true), F.col("class") == F.col("near")).select("asking", "near", "list").toArrow()
    far = np.sqrt(squared_distances(points, graph.centres))
    nearest = far.min(1)
    least = float(np.quantile(nearest, 0.1))
    if not held.num_rows or least <= 0:
        least = max(least, float(far.mean()) * 1e-3, 1e-300)
    row = {c: i for i, c in enumerate(asking.tolist())}
    rows = np.array([row[c] for c in held.column("asking").to_pylist()], int)
    needed = far[rows, held.column("list").to_numpy()] / np.maximum(nearest[rows], least) if len(rows) else np.empty(0)
    # A neighbour is met in the nearest of its lists.
    met: dict[tuple[int, int], float] = {}
    for pair, need in zip(zip(rows.tolist(), held.column("near").to_pylist(), strict=True), needed.tolist(), strict=True):
        met[pair] = min(need, met.get(pair, np.inf))
    ratio = float(np.quantile(list(met.values()), RECALL, method="higher")) if met else 1.0
    return Reach(max(1.0, ratio) * (1 + 1e-9), least, sizes, room)


def probes(asked: DataFrame, graph: Graph, reach: Reach) -> DataFrame:
    """``list``, ``asking`` (class of the query), its ``point``, and whether the list is among its ``first``, for each list that it reads."""

    def walk(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                rows, lists, firsts = reach.lists(graph, _arrays(batch.column("embedding")))
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), taken.column("class"), taken.column("embedding"), pa.array(firsts)], ["list", "asking", "point", "first"]
                )

    return asked.select("class", "embedding").mapInArrow(walk, "list int, asking bigint, point array<double>, first boolean")


def _best_in_list(key, left, right, k: int):
    """The ``k`` nearest vectors of a list segment, none beyond its bound, for each of a block of queries."""
    import pyarrow as pa

    asking, classes_, ids, scores = [], [], [], []
    if left.num_rows and right.num_rows:
        points, vectors = (_arrays(t.column(c).combine_chunks()) for t, c in ((left, "point"), (right, "embedding")))
        own, first = right.column("class").to_numpy(), right.column("first_id").to_numpy()
        for query, point, bound in zip(left.column("asking").to_pylist(), points, left.column("bound").to_pylist(), strict=True):
            score = np.sqrt(((vectors - point) ** 2).sum(1))
            best = np.lexsort((first, score))[:k] if len(score) <= 4 * k else _few(score, first, k)
            best = best[score[best] <= bound]
            asking += [query] * len(best)
            classes_ += own[best].tolist()
            ids += first[best].tolist()
            scores += score[best].tolist()
    return pa.table({"asking": pa.array(asking, pa.int64()), "class": pa.array(classes_, pa.int64()),
                     "first_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})


def _few(score, first, k: int):
    near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
    return near[np.lexsort((first[near], score[near]))[:k]]


def _read(lists: DataFrame, reads: DataFrame, k: int) -> DataFrame:
    """``asking``, ``class``, ``first_id`` and ``score`` of what the lists that are read give. A segment of a list meets each block of its
    queries, and a block each segment."""
    sizes = lists.groupBy("list").agg(F.ceil(F.count("*") / SEGMENT).cast("int").alias("segments"))
    loads = reads.groupBy(F.col("list").alias("read_list")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cuts = stored(sizes.join(loads, F.col("list") == F.col("read_list")).select(F.col("list").alias("cut_list"), "segments", "blocks"), "list-cuts")
    left = reads.join(cuts, F.col("list") == F.col("cut_list")).select(
        "list", F.pmod(F.xxhash64("asking"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.expr("segments - 1"))).alias("segment"), "asking", "point", "bound"
    )
    right = lists.join(cuts, F.col("list") == F.col("cut_list")).select(
        "list", F.explode(F.sequence(F.lit(0), F.expr("blocks - 1"))).alias("block"), F.pmod(F.xxhash64("class"), "segments").cast("int").alias("segment"), "class", "first_id", "embedding"
    )
    keys = ["list", "block", "segment"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda key, a, b: _best_in_list(key, a, b, k), "asking bigint, class bigint, first_id bigint, score double"
    )


def search(vectors: DataFrame, queries: str = "vec_id % 100 = 0", k: int = NEIGHBOURS) -> DataFrame:
    """The ``k`` nearest rows found for each row that meets ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    rows = stored(usable(vectors), "vectors")
    indexed = stored(classes(rows, k), "vector-classes")
    graph = fit(indexed)
    if graph is None:
        return rows.selectExpr("vec_id as query_id", "0 as rank", "vec_id", "0d as score")
    lists = stored(postings(indexed, graph), "posting-lists")
    named = rows.filter(queries).distinct().join(indexed.select(F.col("embedding").alias("of"), "class", "ids"), F.col("embedding") == F.col("of"))
    asking = stored(named.select(F.col("vec_id").alias("query_id"), "class"), "queries")
    asked = indexed.join(asking.select(F.col("class").alias("asked")).distinct(), F.col("class") == F.col("asked"), "left_semi")
    reads = stored(probes(asked, graph, calibrated(indexed, lists, asked, graph, k)), "probes")
    by_score = F.row_number().over(Window.partitionBy("asking").orderBy("score", "first_id"))

    def best(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("nth", by_score).filter(F.col("nth") <= k + 1).drop("nth")

    # The first lists hold enough vectors to answer with. What they give bounds what is worth naming in all others.
    early = stored(best(_read(lists, reads.filter("first").withColumn("bound", F.lit(float("inf"))), k + 1)), "first-lists")
    bounds = early.groupBy(F.col("asking").alias("of")).agg(F.when(F.count("*") > k, F.max("score")).otherwise(float("inf")).alias("bound"))
    rest = reads.filter("not first").join(bounds, F.col("asking") == F.col("of"), "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    later = _read(lists, rest.drop("of"), k + 1)
    nearest = stored(best(early.unionByName(later)).select("asking", F.col("class").alias("near"), "score"), "nearest")
    ids = nearest.join(indexed.select("class", "ids"), F.col("near") == F.col("class")).select("asking", "score", F.explode("ids").alias("vec_id"))
    pairs = asking.join(ids, F.col("class") == F.col("asking")).filter("vec_id <> query_id").select("query_id", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
