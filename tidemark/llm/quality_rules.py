"""Quality rules: fixed base rules, and a decision list learned by sequential covering.

Every whole text is counted once (words, symbols, repeated lines, repeated three-word windows and a few more); the counts are
written, and everything else is expressions over them. The list is learned from labelled documents that pass the base rules:
a rule is grown, condition by condition, from thresholds on the statistics by the information it gains on two thirds of the
rows, cut back to the beginning that separates the other third best, and kept while it is right there in ``PRECISION`` of
what it covers; the rows it covers are set aside and the next rule is grown. The rules become one ordered Spark ``CASE``.

The list is learned on at most ``FIT_ROWS`` labelled rows, half of each class where there are as many, weighed back to their
share and drawn by a seeded hash of the id from those labels that meet a document that passes the base rules. Only their
statistics (a fixed number of doubles a row) reach the driver. Ids whose crc32 is a multiple of 5 are held out of learning.

Defined cases: null and empty texts, and texts of white space, have no words and fail the base rules; a row without an id is
judged, not learned from; equal rows give equal results; labels that are null are not learned from, an id with several labels
counts with each; without labels of both classes the list is empty and the base rules decide; an empty table gives no rows;
other columns of ``docs`` are not read by ``rule_report`` and kept by ``keep_passing``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import wordhash as wh
from tidemark.llm.base import stored
from tidemark.llm.quality_model import held_out

FIT_ROWS = 20_000
PRECISION, MAX_CONDITIONS = 0.9, 6
MIN_WORDS, REPEAT_PERCENT = 50, 50
SEED = 12

SYMBOLS = "#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_same_next", "n_upper", "n_digits",
    "n_punct", "longest",
)
#: Statistics that rules may test, over the counts.
STATISTICS = {
    "words": "double(n_words)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "longest_word": "double(longest)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "punct_share": "n_punct / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "same_next_share": "n_same_next / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}
BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"

#: A condition (statistic, whether above, threshold) and a rule, which holds where all of its conditions do.
Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]

# ---------------------------------------------------------------- counts


def _kind(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_SYMBOL = _kind(SYMBOLS)
_UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _kind("0123456789")
_PUNCT = _kind("!\"'()+,-./:;=?@[\\]^_`{}~")
_WHITE = " \t\n\v\f\r"


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set before each end and after the one before it."""
    return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[np.append(0, ends)])


def _first_seen(keys: np.ndarray) -> np.ndarray:
    """Whether each key stands at its first place."""
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    return first


def _lines(texts: list[str]) -> tuple[list[int], list[int]]:
    """Lines with a word, and those of them that repeat an earlier one."""
    n, repeats = [], []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip(_WHITE)]
        n.append(len(lines))
        repeats.append(len(lines) - len(set(lines)))
    return n, repeats


def count(data: np.ndarray, ends: np.ndarray, texts: list[str]) -> dict[str, np.ndarray]:
    """``COUNTS`` of each of the ``texts``, whose bytes end at ``ends`` in ``data``."""
    words, until, starts, stops = wh.word_hashes(data, ends, lower=False, spans=True)
    n_words = np.diff(np.append(0, until))
    char = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64))
    length = char[stops] - char[starts]
    of_text = np.repeat(np.arange(len(n_words)), n_words)
    salt = wh.mix(of_text.astype(np.uint64) + np.uint64(1))
    # Windows of three words within one text; a window repeats if its key occurs twice.
    covered = np.zeros(len(words), bool)
    if len(words) > 2:
        windows = np.flatnonzero(of_text[:-2] == of_text[2:])
        keys = wh.mix(wh.mix(wh.mix(words[windows] + salt[windows]) + words[windows + 1]) + words[windows + 2])
        _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = windows[times[place] > 1]
        for k in range(3):
            covered[again + k] = True
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (of_text[1:] == of_text[:-1])
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, of_text, length)
    n_lines, n_dup_lines = _lines(texts)
    return {
        "n_words": n_words, "word_chars": np.diff(np.append(0, np.append(0, np.cumsum(length))[until])),
        "n_symbols": _per_text(_SYMBOL[data], ends), "n_dup_lines": n_dup_lines, "n_repeat_words": _per_text(covered, until), "n_lines": n_lines,
        "n_distinct": _per_text(_first_seen(wh.mix(words + salt)), until), "n_same_next": _per_text(same, until),
        "n_upper": _per_text(_UPPER[data], ends), "n_digits": _per_text(_DIGIT[data], ends), "n_punct": _per_text(_PUNCT[data], ends), "longest": longest,
    }


def counted(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``COUNTS`` of every row's whole text."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*[docs.schema[c] for c in keep], *[StructField(c, LongType()) for c in COUNTS]])

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, data, ends in wh.text_batches(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = count(data, ends, texts)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(found[c], pa.int64()) for c in COUNTS]], [*keep, *COUNTS])

    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(rows, schema)


# ---------------------------------------------------------------- learning


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for name, above, threshold in rule:
        held &= (x[name] > threshold) if above else (x[name] <= threshold)
    return held


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold whose side gains most information about bad rows, per bad row kept; ties to the first statistic."""
    p0, n0 = weight[bad].sum(), weight[~bad].sum()
    before = np.log2(p0 / (p0 + n0))
    best, chosen = 1e-9, None
    for name, values in x.items():
        order = np.argsort(values, kind="stable")
        v = values[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        p_low, n_low = np.cumsum(np.where(bad, weight, 0)[order])[cuts], np.cumsum(np.where(bad, 0, weight)[order])[cuts]
        for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
            p, n = np.maximum(p, 0), np.maximum(n, 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 1e-9, p * (np.log2(p / (p + n)) - before), 0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                low, high = float(v[cuts[i]]), float(v[cuts[i] + 1])
                middle = (low + high) / 2
                best, chosen = float(gain[i]), (name, above, middle if low <= middle < high else low)
    return best, chosen


def _grown(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> Rule:
    rule: list[Condition] = []
    rows = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (bad & rows).any() and (~bad & rows).any():
        _, condition = _best_condition({k: v[rows] for k, v in x.items()}, bad[rows], weight[rows])
        if condition is None:
            break
        rule.append(condition)
        rows &= _covers((condition,), x, len(bad))
    return tuple(rule)


def _pruned(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> tuple[Rule, float]:
    """The beginning of ``rule`` that separates best, the shortest of several, and its share of bad rows."""
    best, worth, right = (), -np.inf, 0.0
    for k in range(1, len(rule) + 1):
        held = _covers(rule[:k], x, len(bad))
        p, n = weight[held & bad].sum(), weight[held & ~bad].sum()
        if p + n > 0 and (p - n) / (p + n) > worth + 1e-12:
            best, worth, right = rule[:k], (p - n) / (p + n), p / (p + n)
    return best, right


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """Ordered rules for bad rows; every third row prunes what the others grow."""
    prune = np.arange(len(bad)) % 3 == 2
    left, rules = np.ones(len(bad), bool), []
    while (left & bad & ~prune).any() and (left & bad & prune).any():
        grow, check = left & ~prune, left & prune
        rule = _grown({k: v[grow] for k, v in x.items()}, bad[grow], weight[grow])
        rule, right = _pruned(rule, {k: v[check] for k, v in x.items()}, bad[check], weight[check])
        if not rule or right < PRECISION:
            break
        covered = _covers(rule, x, len(bad)) & left
        if not (covered & bad).any():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def train(counts: DataFrame, labels: DataFrame) -> list[Rule]:
    """The list for ``counts(doc_id, ...)``, learned from ``labels(doc_id, quality)``."""
    known = labels.filter("quality is not null").filter(~held_out()).select(
        F.col("doc_id").alias("labelled_id"), (F.col("quality") > 0).cast("int").alias("good")
    )
    met = counts.filter(f"not ({BASE_FAILED})").join(known, F.col("doc_id") == F.col("labelled_id")).select(
        "labelled_id", "good", *[F.expr(e).alias(s) for s, e in STATISTICS.items()]
    )
    met = stored(met, "labelled-statistics")
    n = {r["good"]: r["count"] for r in met.groupBy("good").count().collect()}
    if len(n) < 2:
        return []
    order = [F.xxhash64(F.lit(SEED), "labelled_id"), "labelled_id", *STATISTICS]
    parts = [met.filter(F.col("good") == g).orderBy(*order).limit(max(FIT_ROWS // 2, FIT_ROWS - n[1 - g])).toArrow() for g in (0, 1)]
    x = {s: np.concatenate([p.column(s).to_numpy() for p in parts]) for s in STATISTICS}
    bad = np.repeat([True, False], [p.num_rows for p in parts])
    weight = np.repeat([n[g] / p.num_rows for g, p in enumerate(parts)], [p.num_rows for p in parts])
    # The classes are woven, so that every third row has both.
    woven = np.random.default_rng(SEED).permutation(len(bad))
    return learn_list({k: v[woven] for k, v in x.items()}, bad[woven], weight[woven])


# ---------------------------------------------------------------- use


def conditional(rules: list[Rule]) -> Column:
    """Number of the first rule that a row meets, from 1; null if none. An ordered ``CASE`` over the counts."""
    number = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        tests = [f"({STATISTICS[s]}) {'>' if above else '<='} {threshold!r}d" for s, above, threshold in rules[i - 1]]
        number = F.when(F.expr(" and ".join(tests)), F.lit(i)).otherwise(number)
    return number


def judged(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rule", conditional(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def rule_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's counts, whether the base rules fail it, whether it is kept, and the learned rule that it meets."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = stored(counted(rows, ("doc_id",)), "text-counts")
    return judged(counts, train(counts, labels)).select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule")


def keep_passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the list, with all their columns."""
    counts = stored(counted(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ("doc_id",)), "text-counts")
    rules = train(counts, labels)
    schema = docs.schema
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own_row"), F.col("text").alias("text"))
    return judged(counted(own, ("own_row",)), rules).filter("kept").select(*[F.col(f"own_row.`{f.name}`") for f in schema.fields])
