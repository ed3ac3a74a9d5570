"""Vector codes, quality rules and hard negatives against plain versions, with nulls, ties, copies and clashing columns."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import WORD
from tidemark.llm import hard_negatives, quality_rules, vector_codes
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int"
CLASH = ["'c' as code", "1 as error", "2 as anchor", "3 as window", "4 as n", "5 as score", "6 as of_label", "'r' as rank"]


def vectors(spark, rows):
    return spark.createDataFrame(rows, VECTORS).selectExpr("*", *CLASH)


def made(n=400, d=16, seed=1):
    order = np.random.default_rng(seed)
    points = np.round(order.normal(size=(n, d)) / 4, 3)
    points[50:80] = points[50]  # copies
    rows = [(i * 5, [float(x) for x in p], int(order.integers(0, 3))) for i, p in enumerate(points)]
    bad = [
        (1, None, 1), (2, [], 1), (3, [math.nan] * d, 1), (4, [math.inf] + [0.0] * (d - 1), 1), (6, [None] + [0.0] * (d - 1), 1), (7, [0.5] * (d - 1), 1),
        (8, [0.25] * d, None), (None, [0.125] * d, 2), (9, [0.0] * d, 0),
    ]
    return rows + bad


def numbers(rows, scale, d=16):
    """Usable rows with whole components."""
    finite = [r for r in rows if r[1] and len(r[1]) == d and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in finite]


# ---------------------------------------------------------------- codes


def plain_nearest(part, book):
    return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(book))


def plain_codes(rows, d=16):
    kept = sorted(numbers(rows, 1024, d), key=lambda r: (r[0] is None, r[0] or 0))
    spans = vector_codes.cuts(d)
    books = [[v[a:b] for _, v, _ in kept[:256]] for a, b in spans]
    for _ in range(4):
        for p, (a, b) in enumerate(spans):
            members = collections.defaultdict(list)
            for _, v, _ in kept:
                members[plain_nearest(v[a:b], books[p])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(members[i]) for c in zip(*members[i], strict=True)] if i in members else e for i, e in enumerate(books[p])]
    found, by_label = [], collections.Counter()
    for i, v, label in kept:
        best = [plain_nearest(v[a:b], book) for (a, b), book in zip(spans, books, strict=True)]
        found.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(s for s, _ in best)))
        by_label[label] += found[-1][3]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], sha) for i, label, code, error in found), key=repr)


def test_codes_equal_a_plain_version(spark):
    rows = made()
    got = vector_codes.code_report(vectors(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_codes(rows)


@pytest.mark.parametrize("d", [3, 6, 16])
def test_few_rows_repeated_ids_and_odd_dimensions(spark, d):
    rows = [(i // 2, [((i * k) % 7) / 8 for k in range(1, d + 1)], i % 2) for i in range(10)] + [(4, [1.0], 0)]
    got = vector_codes.code_report(vectors(spark, rows)).collect()
    want = plain_codes(sorted(rows, key=lambda r: (r[0], r[1])), d)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [], 1)]):
        got = vector_codes.code_report(vectors(spark, rows))
        assert got.count() == 0 and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert hard_negatives.negative_report(vectors(spark, rows)).count() == 0


def test_very_large_components(spark):
    rows = [(i, [float(x) for x in (1e30, -1e30, 1e12 * i, 5.0)], 0) for i in range(6)]
    got = vector_codes.code_report(vectors(spark, rows)).collect()
    assert len(got) == 6 and all(0 <= r.error < 1 << 63 for r in got)
    assert hard_negatives.negative_report(vectors(spark, rows)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 90), st.integers(1, 5), st.sampled_from([3, 50, 1 << 20, 1 << 40]), st.integers(0, 99))
def test_search_finds_the_lowest_nearest_entry(n_book, n, width, top, seed):
    order = np.random.default_rng(seed)
    book, parts = order.integers(-top, top, (n_book, width)), order.integers(-top, top, (n, width))
    codes, errors, measured = vector_codes.nearest(parts, book)
    want = [plain_nearest(p, book.tolist()) for p in parts.tolist()]
    assert list(zip(map(int, errors), codes.tolist(), strict=True)) == want and n <= measured <= n * n_book


def test_search_measures_few_pairs_where_sums_tell_parts_apart():
    order = np.random.default_rng(2)
    book = order.normal(size=(256, 1)) * 5000 + order.normal(size=(256, 16)) * 100
    parts = book[order.integers(0, 256, 20_000)] + order.normal(size=(20_000, 16)) * 20
    assert vector_codes.nearest(np.floor(parts).astype(np.int64), np.floor(book).astype(np.int64))[2] < 20_000 * 256 / 4


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows, d=16):
    kept = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(v)) for i, v, label in numbers(rows, 256, d) if i is not None and label is not None}
    out = []
    for a, own, v in sorted(kept):
        if a % 100:
            continue
        scored = [(-sum(map(lambda x, y: x * y, v, w)), i, label) for i, label, w in kept if i != a]
        for p, i, _ in sorted(s for s in scored if s[2] == own)[:5]:
            window = sorted((s, j) for s, j, label in scored if label != own and -80 * p <= -100 * s <= -100 * p)
            out += [(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(window[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("segment,block,sample", [(8192, 2048, 4096), (64, 2, 8), (64, 2, 50)])
def test_negatives_equal_a_plain_version(spark, monkeypatch, segment, block, sample):
    monkeypatch.setattr(hard_negatives, "SEGMENT", segment)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
    rows = made(300, seed=4)
    got = hard_negatives.negative_report(vectors(spark, rows + rows[50:150])).collect()
    want = plain_negatives(rows)
    assert want and sorted(map(tuple, got)) == want


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 60), st.integers(1, 24), st.integers(0, 99), st.sampled_from([-math.inf, -50.0, 0.0, 40.0, 300.0]), st.booleans())
def test_index_reaches_every_row_above_the_threshold(n, d, seed, threshold, sparse):
    order = np.random.default_rng(seed)
    x, q = (np.floor(order.normal(size=(m, d)) * 6) * (order.random((m, d)) < (0.3 if sparse else 1)) for m in (n, 4))
    index = hard_negatives.Index(x, q, threshold)
    for anchor in q:
        near, score = index.reaching(anchor, threshold)
        want = x @ anchor
        assert sorted(near.tolist()) == np.flatnonzero(want >= threshold).tolist() and (score == want[near]).all()


def test_index_omits_covered_dimensions():
    order = np.random.default_rng(3)
    x = order.normal(size=(2000, 64)) * 0.5 ** (np.arange(64) / 4) * 100
    index = hard_negatives.Index(np.floor(x), np.floor(x[:20]), 5_000.0)
    assert sum(index.heads) < 2000 * 8 / 2


# ---------------------------------------------------------------- rules


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def speech(seed, n, mark=0.0):
    order = random.Random(seed)
    return " ".join("".join(order.choice("abcdefgh") for _ in range(order.randint(2, 7))) + ("***" if order.random() < mark else "") for _ in range(n))


TEXTS = [
    None, "", " \t\n ", "one two", "naïve café ünïcode 漢字 " * 20, "a b c " * 40, "same line\nsame line\n\n \nsame line\r\n" * 9,
    speech(1, 20_000), speech(1, 20_000), "# * $ % & | < > " * 10, "x y z w\v\fq " * 15, "line\n" * 60, speech(2, 60) + "\n" + speech(2, 60), "a b c a b c",
]
CLASHING = ["'k' as key", "1 as n_words", "2 as rule", "true as kept", "'o' as own_row", "0 as good", "'w' as words"]


def labelled(spark):
    texts = [*TEXTS, *[speech(s, 80, mark=0.4 if s % 4 == 0 else 0.0) for s in range(200)]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").selectExpr("*", *CLASHING)
    marks = [(i, None if i < 5 else int((i - len(TEXTS)) % 4 != 0)) for i in range(len(texts))]
    return texts, docs, spark.createDataFrame(marks, "doc_id bigint, quality int")


def test_counts_and_learned_rules(spark):
    texts, docs, labels = labelled(spark)
    null_id = docs.filter("doc_id = 20").drop("doc_id").selectExpr("cast(null as bigint) as doc_id", "*").select(*docs.columns)
    got = quality_rules.rule_report(docs.unionByName(docs.filter("doc_id < 30")).unionByName(null_id), labels).collect()
    assert len(got) == len(texts) + 31
    for r in got:
        want = plain_counts(texts[20 if r.doc_id is None else r.doc_id])
        assert tuple(r)[1:7] == want and r.kept == (not r.base_failed and r.rule is None)
        if r.doc_id is not None and r.doc_id >= len(TEXTS):
            assert r.kept == ((r.doc_id - len(TEXTS)) % 4 != 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b ", "\n", " ", "ü#", " ", "a b c ", "|"]), max_size=40).map("".join), min_size=1, max_size=5))
def test_counts_of_any_texts(texts):
    parts = [t.encode() for t in texts]
    found = quality_rules.count(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]), texts)
    assert [tuple(int(found[c][i]) for c in quality_rules.COUNTS[:5]) for i in range(len(texts))] == [plain_counts(t)[:5] for t in texts]


def test_kept_rows_have_all_columns(spark):
    _, docs, labels = labelled(spark)
    kept = {r.doc_id for r in quality_rules.rule_report(docs, labels).filter("kept").collect()}
    got = quality_rules.keep_passing(docs, labels)
    assert got.schema == docs.schema and {r.doc_id for r in got.collect()} == kept


def test_without_labels_the_base_rules_decide(spark):
    _, docs, labels = labelled(spark)
    for none in (labels.filter("false"), labels.filter("quality = 1")):
        assert quality_rules.rule_report(docs, none).filter("kept = base_failed or rule is not null").count() == 0
    assert quality_rules.rule_report(docs.filter("false"), labels).count() == 0


def test_list_of_conjunctions():
    order = np.random.default_rng(5)
    x = {k: order.random(6000) for k in ("words", "mean_word", "digit_share")}
    bad = ((x["words"] > 0.6) & (x["mean_word"] <= 0.3)) | (x["digit_share"] > 0.9)
    noisy = bad ^ (order.random(6000) < 0.01)
    rules = quality_rules.learn_list(x, noisy, np.ones(6000))
    hit = np.zeros(6000, bool)
    for rule in rules:
        hit |= quality_rules._covers(rule, x, 6000)
    assert (hit == bad).mean() > 0.98 and any(len(r) > 1 for r in rules) and all(len({c[0] for c in r}) <= len(r) for r in rules)


def test_conditional_is_an_ordered_case(spark):
    rules = [(("words", True, 10.0), ("symbol_share", False, 0.5)), (("words", True, 5.0),)]
    rows = spark.createDataFrame([(12, 1, 0), (12, 1, 1), (7, 1, 0), (3, 1, 0)], "n_words bigint, word_chars bigint, n_symbols bigint")
    assert [r.rule for r in rows.select(quality_rules.conditional(rules).alias("rule")).collect()] == [1, 2, 2, None]


def test_held_out_accuracy(spark):
    from tidemark.llm.quality_model import held_out

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(held_out())
    judged = QUERIES["op12_quality_rules"](spark, sf).filter("not base_failed").join(labels, "doc_id")
    rows = judged.selectExpr("kept", "quality = 1 as good").collect()
    assert sum(r.kept == r.good for r in rows) >= 0.95 * len(rows) > 0
