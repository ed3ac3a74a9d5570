"""Quality scores by naive Bayes support vectors.

Texts become sets of hashed n-gram indicators: words and word pairs, word shapes and shape pairs, and the shares of a text
that its shapes and repeated words make up, in steps. Class counts of every indicator over the sampled training rows
give log-count ratios; the indicators, scaled by these, feed a linear model with hinge loss, fitted by dual coordinate
descent. A logistic curve, fitted on rows that the model has not seen, turns margins into scores.

The classifier is fitted on a bounded sample of the labelled rows: at most ``FIT_ROWS`` for the class counts and the
linear model and ``CURVE_ROWS`` for the curve, and ``FIT_BYTES`` of indicators, chosen from the labels that meet a document by a seeded hash
and as even between the classes as their numbers allow; the curve weighs the classes back to their share. So the labels that meet the documents are
few enough to be broadcast, whatever the size of either table, and no text is shuffled.

Defined cases: null and empty texts have no indicators and get the score of the intercept; rows with several labels
count with each; rows without a label or with a null one are scored only; without rows of both classes every score is
the share of label 1 (1 if nothing is labelled); an empty table gives no rows; extra columns are kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import wordhash as wh
from tidemark.llm.base import stored

FEATURES = 1 << 18
FIT_ROWS, CURVE_ROWS = 6_000, 3_000
#: Bytes of indicators (4 each, 1 MB a text at most) that the driver fits on.
FIT_BYTES = 96 << 20
THRESHOLD = 0.3
C, EPOCHS, SMOOTH = 0.1, 12, 1.0
SHARES = np.array([1, 2, 4, 8, 16, 32])
SEED = 5

# ---------------------------------------------------------------- indicators

_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48


def _shapes(data, starts, stops):
    """A number per word: classes of its first two and last two bytes."""
    last = len(data) - 1
    second, before = np.minimum(starts + 1, stops - 1), np.maximum(stops - 2, starts)
    parts = [_CLASS[data[np.minimum(p, last)]] for p in (starts, second, before, stops - 1)]
    return (parts[0] << np.uint64(24)) | (parts[1] << np.uint64(16)) | (parts[2] << np.uint64(8)) | parts[3]


def _hashed(values, salt: int):
    return (wh.mix(values + np.uint64(salt * wh.BASE % 2**64)) % np.uint64(FEATURES)).astype(np.int32)


def indicators(data, ends) -> list:
    """Per text its sorted distinct feature numbers."""
    words, counts, starts, stops = wh.word_hashes(data, ends, spans=True)
    shapes = _shapes(data, starts, stops)
    pair = wh.mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) else words
    shape_pair = wh.mix(shapes[:-1] * np.uint64(1 << 32) + shapes[1:]) if len(words) else words
    unigrams, bigrams = _hashed(words, 1), _hashed(pair, 2)
    shape2 = _hashed(shape_pair, 4)
    again = [np.zeros(len(words), bool) for _ in range(2)]
    for k, same in enumerate(again, 1):
        same[k:] = words[k:] == words[:-k]
    found, start = [], 0
    for end in counts.tolist():
        n = end - start
        if not n:
            found.append(np.empty(0, np.int32))
            continue
        kinds, times = np.unique(shapes[start:end], return_counts=True)
        reps = [int(same[start + k : end].sum()) if n > k else 0 for k, same in enumerate(again, 1)]
        kinds = np.append(kinds, np.array([1 << 40, 2 << 40], np.uint64))
        times = np.append(times, reps)
        over = times[:, None] * SHARES[None, :] >= n
        shares = (kinds[:, None] + (np.uint64(1 << 33) * np.arange(1, len(SHARES) + 1, dtype=np.uint64))[None, :])[over]
        size = np.array([n.bit_length()], np.uint64)
        found.append(np.unique(np.concatenate([
            unigrams[start:end], bigrams[start : end - 1], shape2[start : end - 1], _hashed(shares, 5), _hashed(size, 6),
        ])))
        start = end
    return found


# ---------------------------------------------------------------- model


@dataclass
class Model:
    weights: np.ndarray  # by feature, with the log-count ratio multiplied in
    bias: float
    slope: float
    offset: float

    def scores(self, rows: list) -> np.ndarray:
        margins = np.array([self.weights[r].sum() for r in rows], np.float64) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -50, 50)))


def log_count_ratio(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    p, q = good + SMOOTH, bad + SMOOTH
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list, labels: np.ndarray, ratio: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-loss linear machine over indicators scaled by ``ratio``, one dual variable at a time."""
    y = np.where(labels > 0, 1.0, -1.0)
    w, b, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    norms = np.array([float((ratio[r] ** 2).sum()) for r in rows]) + 1.0
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            r = rows[i]
            x = ratio[r]
            gradient = y[i] * (w[r] @ x + b) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), C)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * x
                b += step
                alpha[i] = new
    return w * ratio, b


def logistic_curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve over margins, by Newton steps on soft labels."""
    good, bad = weights[labels > 0].sum(), weights[labels <= 0].sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(float(np.abs(margins).mean()), 1e-9)
    m = margins / scale
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -50, 50)))
        g, h = weights * (p - target), weights * p * (1 - p) + 1e-9
        ga, gb = float(g @ m) + 1e-3 * a, float(g.sum())
        haa, hab, hbb = float(h @ (m * m)) + 1e-3, float(h @ m), float(h.sum()) + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
    return a / scale, b


# ---------------------------------------------------------------- training on the cluster


def held_out(doc_id: str = "doc_id") -> Column:
    """Ids whose rows are never learnt from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _place() -> Column:
    """Seeded order of labelled rows."""
    return F.xxhash64(F.lit(SEED), "labelled_id")


def _sampled(known: DataFrame, n: dict[int, int]) -> DataFrame:
    """At most ``FIT_ROWS + CURVE_ROWS`` of ``known(labelled_id, label)``, half of each class if there are as many."""
    room = FIT_ROWS + CURVE_ROWS
    parts = [
        known.filter(F.col("label") == label).orderBy(_place(), "labelled_id").limit(max(room // 2, room - n.get(1 - label, 0)))
        for label in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def _indicated(rows: DataFrame) -> DataFrame:
    """``label``, ``place`` and the indicators of each row's text, as bytes."""

    def indicate(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, data, ends in wh.text_batches(batches):
            found = pa.array([f.astype("<i4").tobytes() for f in indicators(data, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("label"), part.column("place"), found], ["label", "place", "found"])

    return rows.mapInArrow(indicate, "label int, place bigint, found binary")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of the labelled rows of ``docs`` that are not held out."""
    known = labels.filter("quality is not null").filter(~held_out()).select(
        F.col("doc_id").alias("labelled_id"), (F.col("quality") > 0).cast("int").alias("label")
    )
    # Labels of other documents would take the place of those that can be learnt from. Only ids are joined.
    known = known.join(docs.select(F.col("doc_id").alias("met")), F.col("labelled_id") == F.col("met"), "left_semi")
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    good, bad = n.get(1, 0), n.get(0, 0)
    chosen = stored(_sampled(known, n), "labelled-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select(
        F.col("text").cast("string").alias("text"), "label", _place().alias("place")
    )
    # An id may stand on many rows, so the bound is kept once more; then that of bytes, over these rows.
    order = ("place", "label", "found")
    sample = _indicated(rows).orderBy(*order).limit(FIT_ROWS + CURVE_ROWS)
    upto = F.sum(F.octet_length("found")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sample = sample.withColumn("upto", upto).filter(F.col("upto") <= FIT_BYTES).select("label", "found").toArrow()
    y = np.array(sample.column("label").to_pylist(), np.int64)
    if len(set(y.tolist())) < 2:
        share = good / (good + bad) if good + bad else 1.0
        return Model(np.zeros(FEATURES), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    x = [np.frombuffer(b, "<i4") for b in sample.column("found").to_pylist()]
    # Every third row of each class is for the curve; too few to spare: it is fitted on all.
    curve = np.zeros(len(y), bool)
    for label in (0, 1):
        curve[np.flatnonzero(y == label)[2::3]] = True
    fit = ~curve
    if len(set(y[curve].tolist())) < 2:
        curve[:] = fit[:] = True
    totals = np.zeros((2, FEATURES))
    for row, label, f in zip(x, y.tolist(), fit, strict=True):
        if f:
            totals[label][row] += 1
    ratio = log_count_ratio(totals[1], totals[0])
    weights, bias = dual_descent([r for r, f in zip(x, fit, strict=True) if f], y[fit], ratio)
    chosen = np.flatnonzero(curve)
    margins = np.array([weights[x[i]].sum() + bias for i in chosen])
    part = {1: good / (good + bad), 0: bad / (good + bad)}
    own = {label: max(1, int((y[chosen] == label).sum())) for label in (0, 1)}
    row_weight = np.array([part[v] / own[v] for v in y[chosen].tolist()]) * len(chosen)
    return Model(weights, bias, *logistic_curve(margins, y[chosen], row_weight))


# ---------------------------------------------------------------- use


def _scored(batches: Iterator, model: Model) -> Iterator:
    for part, data, ends in wh.text_batches(batches):
        yield part, model.scores(indicators(data, ends))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, and whether its label was held out."""
    model = train(docs, labels)

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, scores in _scored(batches, model):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model predicts as good, with all their columns."""
    model = train(docs, labels)

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, scores in _scored(batches, model):
            yield part.filter(pa.array(scores >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
