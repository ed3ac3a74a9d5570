"""Hard negatives by threshold joins over an inverted index with norm bounds.

The anchors are a stated set of rows; each wants, among all rows, the first few of its own label (its positives) and, for each
positive, the first few of other labels whose score lies in a window below the positive's. Both are windows of scores, searched
by the same join. Anchors are dealt into blocks and rows into segments, and each block meets each segment once.

In a segment, dimensions are taken from the heaviest to the lightest. A row's entries are indexed only up to the place from which its
remaining norm, times the largest remaining norm of an anchor of the block, stays under the lowest threshold: what is left out could not lift a
pair to it on its own. Rows are sorted by that place, so a dimension's posting list is the head of its column. Partial
scores add up over the lists, a few dimensions at a time; a row goes when its partial score and the product of the remaining
norms stay under the anchor's threshold. Rows that are left are measured in full, so results are exact.

Thresholds begin high and are lowered until windows fill: a window's first threshold is its best score among a bounded sample of
rows, the next one its k-th best there, which k rows are known to reach, the last one its floor. A window that holds k
rows at or above its threshold is done, as the join misses none of these. A segment gives at most ``k`` rows a window.

Defined cases: rows without an id or a label, and rows whose vector is null, empty, holds a null or non-finite component or is
not of the most common dimension (the largest of several), take no part; rows that share an id with an anchor are not its
partners; equal rows (id, label, vector) count once; ties go to smaller ids; a positive below zero has an empty window;
anchors without partners give no rows; an empty table gives none; other columns are not read. Scores are sums of doubles,
exact up to 2**53; scores beyond a long are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import stored

POSITIVES, NEGATIVES = 5, 5
LOW_PERCENT = 80
SCALE = 256
#: Anchors of a block, rows of a segment, dimensions added up between two prunings.
BLOCK, SEGMENT, STRIDE = 2048, 8192, 8
#: Rows that first thresholds are taken from.
SAMPLE = 4096
#: Slack of norm bounds against rounding.
SLACK = 1e-9

WINDOWS = "array<struct<window:bigint,high:double,low:double>>"
FOUND = "anchor bigint, window bigint, vec_id bigint, score double"


# ---------------------------------------------------------------- one block and one segment


def whole(column, dimension: int) -> np.ndarray:
    """Vectors of scaled components, rounded down."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.floor(np.clip(flat * SCALE, -1e150, 1e150)).reshape(-1, dimension)


def _tails(x: np.ndarray, stops: list[int]) -> np.ndarray:
    """Norms of what is left of each row from each of ``stops`` on."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(x), 1))], axis=1)
    return np.sqrt(squares[:, stops])


class Index:
    """Posting lists of a segment for thresholds of at least ``lowest``."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, lowest: float):
        dimension = rows.shape[1]
        self.order = np.argsort(-(rows * rows).sum(0), kind="stable")
        x, q = rows[:, self.order], anchors[:, self.order]
        self.stops = [*range(0, dimension, STRIDE), dimension]
        tails, reach = _tails(x, self.stops), _tails(q, self.stops).max(0, initial=0)
        # The first stop from which a row needs no postings.
        covered = tails * reach * (1 + SLACK) < lowest
        self.until = np.argmax(covered, axis=1) if lowest > 0 else np.full(len(x), len(self.stops) - 1)
        self.until = np.where(covered.any(1) & (lowest > 0), self.until, len(self.stops) - 1)
        self.by_place = np.argsort(-self.until, kind="stable")
        self.x, self.tails = np.ascontiguousarray(x[self.by_place]), tails[self.by_place]
        # Rows that have postings in each stride: a head of the sorted rows.
        self.heads = [int(np.count_nonzero(self.until > i)) for i in range(len(self.stops) - 1)]
        self.lists = [np.ascontiguousarray(self.x[: self.heads[i], a:b]) for i, (a, b) in enumerate(zip(self.stops, self.stops[1:]))]

    def reaching(self, anchor: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose score is at least ``threshold``, and their scores."""
        q = anchor[self.order]
        if threshold == -np.inf:
            return self.by_place, self.x @ q
        tails = _tails(q[None, :], self.stops)[0]
        bar = threshold - SLACK * max(1.0, abs(threshold))
        alive, partial = None, None
        for i, postings in enumerate(self.lists):
            a, b = self.stops[i], self.stops[i + 1]
            if alive is None:
                # The first list starts the candidates; rows without postings fall under the bound of their whole norm.
                alive, partial = np.arange(len(postings)), postings @ q[a:b]
            else:
                inside = int(np.searchsorted(alive, self.heads[i]))
                partial[:inside] += postings[alive[:inside]] @ q[a:b]
            # What a row has no postings for from here on is within its tail from where they end.
            from_ = np.minimum(self.until_of(alive), i + 1)
            keep = partial + self.tails[alive, from_] * tails[from_] * (1 + SLACK) >= bar
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
        exact = self.x[alive] @ q
        reached = exact >= threshold
        return self.by_place[alive[reached]], exact[reached]

    def until_of(self, places: np.ndarray) -> np.ndarray:
        return self.until[self.by_place[places]]


def first_in_windows(anchors: dict, rows: dict, same: bool, k: int) -> tuple[list, list, list, list]:
    """Per anchor and window the first ``k`` rows (anchor, window, id, score).

    ``anchors`` has ``anchor``, ``vec_id``, ``label``, ``x`` and ``windows`` (lists of window, high, low), ``rows`` has ``vec_id``, ``label``, ``x``.
    """
    found: tuple[list, list, list, list] = ([], [], [], [])
    if not len(rows["vec_id"]) or not len(anchors["vec_id"]):
        return found
    lowest = min((w["low"] for ws in anchors["windows"] for w in ws), default=np.inf)
    index = Index(rows["x"], anchors["x"], lowest)
    for i, windows in enumerate(anchors["windows"]):
        near, score = index.reaching(anchors["x"][i], min((w["low"] for w in windows), default=np.inf))
        label = rows["label"][near] == anchors["label"][i]
        partner = (label if same else ~label) & (rows["vec_id"][near] != anchors["vec_id"][i])
        near, score = near[partner], score[partner]
        ids = rows["vec_id"][near]
        for w in windows:
            inside = np.flatnonzero((score <= w["high"]) & (score >= w["low"]))
            if len(inside) > k:
                bar = -np.partition(-score[inside], k - 1)[k - 1]
                inside = inside[score[inside] >= bar]
            best = inside[np.lexsort((ids[inside], -score[inside]))][:k]
            found[0].extend([anchors["anchor"][i]] * len(best))
            found[1].extend([w["window"]] * len(best))
            found[2].extend(ids[best].tolist())
            found[3].extend(score[best].tolist())
    return found


def _rows(table, dimension: int) -> dict:
    return {
        "vec_id": table.column("vec_id").to_numpy(), "label": table.column("label").to_numpy(),
        "x": whole(table.column("embedding").combine_chunks(), dimension),
    }


def _anchors(table, dimension: int) -> dict:
    return {
        "anchor": table.column("anchor").to_pylist(), "vec_id": table.column("vec_id").to_numpy(), "label": table.column("label").to_numpy(),
        "x": whole(table.column("embedding").combine_chunks(), dimension), "windows": table.column("windows").to_pylist(),
    }


def _table(found: tuple[list, list, list, list]):
    import pyarrow as pa

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names=["anchor", "window", "vec_id", "score"])


# ---------------------------------------------------------------- the join


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``embedding`` of the rows that take part; labels are moved by the caller."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding").filter(
        "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    )
    top = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("embedding") == (top["n"] if top else 0))


def _joined(asked: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, dimension: int, same: bool, k: int) -> DataFrame:
    """Per window the first ``k`` rows of each segment."""
    blocks, segments = max(1, -(-n_anchors // BLOCK)), max(1, -(-n_rows // SEGMENT))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block"), every(segments).alias("segment"), "anchor", "vec_id", "label", "embedding", "windows")
    right = rows.select(every(blocks).alias("block"), F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(segments)).cast("int").alias("segment"), "vec_id", "label", "embedding")

    def meet(key, a, b):
        if not a.num_rows or not b.num_rows:
            return _table(([], [], [], []))
        return _table(first_in_windows(_anchors(a, dimension), _rows(b, dimension), same, k))

    return left.groupBy("block", "segment").cogroup(right.groupBy("block", "segment")).applyInArrow(meet, FOUND)


def _levels(asked: DataFrame, sample: dict, dimension: int, same: bool, k: int) -> DataFrame:
    """``anchor``, ``window`` and its thresholds from high to low: best and k-th best of the sample, then the floor."""

    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, BLOCK):
                batch = pa.Table.from_batches([whole_batch.slice(start, BLOCK)])
                anchors = _anchors(batch, dimension)
                met: dict = {}
                for a, w, _, s in zip(*first_in_windows(anchors, sample, same, k), strict=True):
                    met.setdefault((a, w), []).append(s)
                out = []
                for a, ws in zip(anchors["anchor"], anchors["windows"], strict=True):
                    for w in ws:
                        s = sorted(met.get((a, w["window"]), []), reverse=True)
                        out.append((a, w["window"], w["high"], w["low"], sorted({*s[:1], *s[k - 1 : k], w["low"]}, reverse=True)))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()))
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "window", "high", "floor", "levels"])

    return asked.mapInArrow(look, "anchor bigint, window bigint, high double, floor double, levels array<double>")


def first_rows(anchors: DataFrame, windows: DataFrame, rows: DataFrame, sample: dict, sizes: tuple[int, int, int], same: bool, k: int) -> DataFrame:
    """``anchor``, ``window``, ``vec_id``, ``score`` of the first ``k`` rows of each of ``windows(anchor, window, high, low)``."""
    n_anchors, n_rows, dimension = sizes

    def asked(open_windows: DataFrame) -> DataFrame:
        grouped = open_windows.groupBy(F.col("anchor").alias("asking")).agg(F.collect_list(F.struct("window", "high", "low")).alias("windows"))
        return anchors.join(grouped, F.col("anchor") == F.col("asking")).select("anchor", "vec_id", "label", "embedding", "windows")

    levels = stored(_levels(asked(windows), sample, dimension, same, k), "thresholds")
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id"))
    waiting, done = levels, None
    for step in range(3):
        now = waiting.select("anchor", "window", "high", F.expr(f"coalesce(try_element_at(levels, {step + 1}), floor)").alias("low"))
        met = _joined(asked(now), rows, n_anchors, n_rows, dimension, same, k)
        best = stored(met.withColumn("nth", rank).filter(F.col("nth") <= k), "first-rows")
        full = best.groupBy(F.col("anchor").alias("of"), F.col("window").alias("in")).agg(F.count("*").alias("n"))
        state = waiting.join(full, (F.col("anchor") == F.col("of")) & (F.col("window") == F.col("in")), "left")
        complete = f"coalesce(n, 0) >= {k} or size(levels) <= {step + 1}"
        finished = state.filter(complete).select(F.col("anchor").alias("of"), F.col("window").alias("in"))
        kept = best.join(finished, (F.col("anchor") == F.col("of")) & (F.col("window") == F.col("in")), "left_semi").drop("nth")
        done = kept if done is None else done.unionByName(kept)
        waiting = stored(state.filter(f"not ({complete})").select(*levels.columns), "open-windows")
        if waiting.isEmpty():
            break
    return done


def mine(
    rows: DataFrame, anchors: str = "vec_id % 100 = 0", positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT
) -> DataFrame:
    """Hard negatives for each anchor and positive among the distinct ``rows(vec_id, label, embedding)``, which should be stored."""
    spark = rows.sparkSession
    asking = stored(rows.filter(anchors).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    n_anchors, n_rows = asking.count(), rows.count()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    dimension = rows.select(F.size("embedding")).first()[0]
    sample = _rows(rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "embedding").limit(SAMPLE).toArrow(), dimension)
    sizes = (n_anchors, n_rows, dimension)
    no_end = F.lit(float("inf"))
    all_scores = asking.select("anchor", F.lit(0).cast("bigint").alias("window"), no_end.alias("high"), (-no_end).alias("low"))
    friends = stored(first_rows(asking, all_scores, rows, sample, sizes, True, positives).select("anchor", F.col("vec_id").alias("positive_id"), "score").distinct(), "positives")
    # Positives of equal scores share a window.
    own = stored(friends.filter("score >= 0").groupBy("anchor", F.col("score").alias("high")).agg(F.min("positive_id").alias("window")), "windows")
    below = own.select("anchor", "window", "high", F.ceil(F.col("high") * low_percent / 100).cast("double").alias("low"))
    foes = first_rows(asking, below, rows, sample, sizes, False, negatives).select(
        F.col("anchor").alias("for_anchor"), F.col("window").alias("for_window"), F.col("vec_id").alias("negative_id"), F.col("score").alias("below")
    )
    keyed = friends.join(own.select(F.col("anchor").alias("of"), "high", "window"), (F.col("anchor") == F.col("of")) & (F.col("score") == F.col("high")))
    pairs = keyed.join(foes, (F.col("anchor") == F.col("for_anchor")) & (F.col("window") == F.col("for_window")))
    named = pairs.join(asking.select(F.col("anchor").alias("named"), F.col("vec_id").alias("anchor_id")), F.col("anchor") == F.col("named"))
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_id", "score").orderBy(F.desc("below"), "negative_id"))
    held = lambda c: F.greatest(F.least(c, F.lit(9.2e18)), F.lit(-9.2e18)).cast("bigint")
    return named.select("anchor_id", "positive_id", rank.alias("rank"), "negative_id", held("score").alias("positive_score"), held("below").alias("negative_score"))


def negative_report(vectors: DataFrame) -> DataFrame:
    """``mine`` over all of ``vectors``, where labels of ids divisible by 7 move on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(stored(usable(vectors).withColumn("label", moved).distinct(), "mined-vectors"))
