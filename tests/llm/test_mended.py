"""Cases that earlier versions got wrong: clashing names, chained stages, odd pages, long lists of spans, labels of other documents."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import exact_dedup, html_text, near_dedup, quality_model, secret_scan, token_files, tokens
from tidemark.llm.base import stored

NAMES = ["dropped_id", "mixed_id", "kept_id", "kept_sha", "dropped_text", "again_id", "again_text", "id", "own", "gone", "twice", "keys", "own_id", "own_key", "text_key", "row", "copies"]


def sentence(seed, n):
    import random

    made = random.Random(seed)
    return " ".join("".join(made.choice("abcdefghij") for _ in range(made.randint(2, 7))) for _ in range(n))


def documents(spark, rows):
    made = spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)], brute.SHAPE)
    return made.selectExpr("*", *[f"'{c}' as `{c}`" for c in NAMES])


BASE = sentence(1, 120)
#: Null and repeated ids on copies, near copies, empty texts and texts of their own.
ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (2, sentence(2, 90)), (3, BASE + " more"), (None, BASE + " other"), (None, sentence(3, 80)), (None, None),
    (4, ""), (5, None), (6, "two words"), (7, sentence(4, 3000)), (7, sentence(4, 3000)), (8, sentence(5, 70)), (8, sentence(6, 70)),
]


@pytest.mark.parametrize("stage", ["exact", "near"])
def test_any_column_names_with_null_and_repeated_ids(spark, stage):
    docs = documents(spark, ROWS)
    got = (exact_dedup if stage == "exact" else near_dedup).keep_distinct(docs)
    assert got.schema == docs.schema
    kept = [(r.doc_id, r.text) for r in got.collect()]
    if stage == "exact":
        assert sorted({t or "" for _, t in kept}) == sorted({t or "" for _, t in ROWS}) and len(kept) == len({t or "" for _, t in ROWS})
        assert (2, BASE) in kept and (5, None) in kept
    else:
        close = [t for _, t in kept if t and t.startswith(BASE)]
        assert len(close) == 1 and (1, BASE) in kept
        assert sum(t in (None, "") for _, t in kept) == 3  # without words, linked with nothing
        assert {t for _, t in kept if t and not t.startswith(BASE)} == {t for _, t in ROWS if t and not t.startswith(BASE)}


def test_stages_chained_without_writing(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lazy, written = docs, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        lazy = stage(spark, lazy, sf)
    for name, stage in corpus_pipeline.STAGES[:3]:
        written = stored(stage(spark, written, sf), name)
    assert sorted(r.doc_id for r in lazy.collect()) == sorted(r.doc_id for r in written.collect())


def test_all_stages_with_null_and_repeated_ids_and_clashing_columns(spark, tmp_path):
    labels = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, ROWS)
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], str(tmp_path)), f"odd-{name}"))
    assert all(f.dtypes == docs.dtypes for f in found[1:-1])
    assert found[1].count() == len(ROWS)  # nothing but good labels: all are accepted
    assert found[2].count() == len({t or "" for _, t in ROWS})
    assert sum(bool(r.text and r.text.startswith(BASE)) for r in found[3].collect()) == 1
    assert all(brute.WORD.search(r.text or "") for r in found[4].collect())
    packed = {(r.doc_id, r.piece) for r in found[5].collect()}
    assert {i for i, _ in packed} == {r.doc_id for r in found[4].collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0


def text_of(page):
    return html_text.main_text(html_text.slots([dict(zip(("token", "slot", "text", "chrome", "article", "linked"), b)) for b in html_text.parse(page)[1]], {}))


def test_lower_case_that_is_longer_does_not_move_the_text():
    page = "<body>" + "İ" * 40 + "<SCRIPT>if (a</b) x</Script><article><p>Hello world text here</p><style>p</STYLE><p>İyi</p></article></body>"
    assert text_of(page) == "Hello world text here\nİyi"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "deep", "<span>" * 3000 + "</i>" * 100_000 + "wide", "<div class='x'>" * 20_000 + "</section>" * 20_000 + "end"])
def test_deep_and_unclosed_pages_stay_small(page):
    import tracemalloc

    tracemalloc.start()
    start = time.perf_counter()
    html_text.parse(page)
    assert time.perf_counter() - start < 60 and tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_very_many_spans_in_one_text(spark):
    text = " ".join(f"{i:032x} token=abcdef{i}" for i in range(25_000))
    docs = spark.createDataFrame([(1, text), (2, "nothing")], "doc_id long, text string")
    start = time.perf_counter()
    got = {r.doc_id: r for r in secret_scan.secret_report(docs).collect()}
    assert time.perf_counter() - start < 60
    want = brute.secrets(text)
    assert got[1].spans == ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in want) and len(want) > 49_000


def test_labels_of_other_documents_do_not_shrink_the_fit(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "FIT_ROWS", 40)
    monkeypatch.setattr(quality_model, "CURVE_ROWS", 20)
    texts = [(i, sentence(i, 60) if i % 2 else "*** $$$ " * 30) for i in range(100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.range(0, 100_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = quality_model.quality_scores(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    monkeypatch.setattr(quality_model, "FIT_BYTES", 4000)
    assert quality_model.quality_scores(docs, labels).count() == 100


def test_a_hot_id_is_dealt_over_files(spark, tmp_path):
    rows = [(7, sentence(i, 400)) for i in range(200)] + [(None, sentence(900 + i, 50)) for i in range(20)] + [(i, "x") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokens.vocabulary_path(), file_bytes=60_000)
    written = token_files.read_tokens(spark, path)
    assert written.filter("doc_id = 7").select("part").distinct().count() >= 3
    placed = written.join(token_files.file_offsets(written), written.part == token_files.F.col("of_part")).selectExpr("doc_id", "ahead + position as start", "n_tokens")
    found = placed.orderBy("start").collect()
    assert [r.doc_id is None for r in found] == sorted((r.doc_id is None for r in found), reverse=True) and [r.doc_id or -1 for r in found] == sorted(r.doc_id or -1 for r in found)
    ends = 0
    for r in found:
        assert r.start == ends
        ends += r.n_tokens


def test_words_across_line_breaks_and_tails_are_learned_once(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    order, coder = random.Random(5), tokens.Encoder(tokens.vocabulary_path())
    coder.encode(["tide la.\nLe mark", "la, Le tide.\nmark "])
    assert not any("\n" in w[1:] for w in coder._numbers)
    words = ["tide", "mark.", "\nLe", "été,", "x1", "", "l'a", "漢", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{'.,'[i % 2]}" for i in range(90))]
    for _ in range(30):
        texts = [" ".join(["tide", *order.choices(words, k=12)]) + order.choice(["", "\n", " ", "\nLe.\nTide"]) for _ in range(4)]
        whole = [e.ids for e in coder._tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)] == whole
    coder._forget()
    assert len(coder._numbers) <= 20 and " tide" in coder._numbers  # a word met in every text stays


def test_a_worker_keeps_few_words_between_tasks(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 400)
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    path = tokens.vocabulary_path()
    for first in (0, 100):
        texts = [f"the tide of tide{i}a, tide{i}b.\nthe tide" for i in range(first, first + 150)]
        whole = tokens.encoder(path)._encoded(texts)
        ((_, flat, counts),) = tokens.encoded(iter([pa.record_batch({"text": pa.array(texts)})]), path, 0)
        assert flat.tolist() == [i for ids in whole for i in [*ids, 0]] and counts.tolist() == [len(ids) + 1 for ids in whole]
        numbers = tokens.encoder(path)._numbers
        assert len(numbers) <= 50 and list(numbers.values()) == list(range(len(numbers))) and {" the", "tide"} <= {*numbers}


def test_words_with_tails_are_learned_as_letters_and_tails():
    coder, tails = tokens.Encoder(tokens.vocabulary_path()), [".", ",", "...", "!?", "\")", "|>", ""]
    texts = [" ".join(f"{w}{t}" for w in ("tide", "Été", "mark", "ĠĊ")) + f"\ntide{t}" for t in tails]
    whole = coder._encoded(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)] == whole
    # Stems after a space, one that begins a text, one a line, and the tails: no word is known with its tail.
    assert {*coder._numbers} == {" tide", "\ntide", "Été", "mark", "ĠĊ", *(" " + t for t in tails if t)}


def test_even_and_uneven_texts_of_a_part_keep_their_order():
    coder = tokens.Encoder(tokens.vocabulary_path())
    white = [c for c in map(chr, range(0x110000)) if c.isspace()]
    texts = [t for c in white for t in (f"tide{c}mark, le", f"tide {c}mark", f"{c}tide mark", f"tide{c}", f"tide{c}{c}\n{c}mark", "tide le.\nmark")]
    texts += ["", None, " ", "\n", "\x1f", "\x1f\x1ftide", "le<|endoftext|>, le", "tide\n\nmark", "3², x9!", "l'a's, it's."]
    whole = [e.ids for e in coder._tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        flat, counts = coder.encode_flat(pa.array(["cut", *texts], kind)[1:], 2)
        assert [ids.tolist() for ids in np.split(flat, np.cumsum(counts)[:-1])] == [[*ids, 2] for ids in whole]
    assert coder.encode_flat(pa.array([], pa.string()), 2)[0].size == 0
