"""The pipeline's stages against plain versions, each on its own input."""

import collections

import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm import brute
from tidemark.llm.base import stored
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF), f"test-{name}"))
    return found


def test_stages_in_order_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_stage_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages[1].collect()}
    scores = QUERIES["op10_quality"](spark, SF)
    assert kept == {r.doc_id for r in scores.filter("predicted = 1").collect()}


def test_dedup_stages(stages):
    before, exact, near = ([(r.doc_id, r.text) for r in s.collect()] for s in stages[1:4])
    groups = brute.grouped(dict(before))
    assert sorted(d for d, _ in exact) == sorted(max(ids) for ids in groups.values())
    want = brute.components({d: brute.shingles(t) for d, t in exact})
    assert sorted(d for d, _ in near) == sorted(d for d, c in want.items() if c == d)


def test_mixing_stage(stages):
    near, mixed = stages[3].collect(), stages[4].collect()
    size = collections.Counter()
    for r in near:
        size[r.source] += len(brute.WORD.findall(r.text or ""))
    taken, copies = collections.Counter(), collections.Counter()
    longest = collections.Counter()
    for r in near:
        longest[r.source] = max(longest[r.source], len(brute.WORD.findall(r.text or "")))
    for r in mixed:
        taken[r.source] += len(brute.WORD.findall(r.text or ""))
        copies[r.doc_id] += 1
    want = brute.targets(dict(size))
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1 for s in size) and max(copies.values()) <= 3


def test_packing_stage(stages):
    mixed, packed = stages[4], stages[5]
    firsts = collections.Counter(r.doc_id for r in packed.filter("piece = 0").collect())
    assert firsts == collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    fills = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    total = sum(r[1] for r in fills)
    assert max(r[1] for r in fills) <= 2048 and len(fills) <= -(-total // 2048) * 1.05 + 2


def test_run_and_registration(spark, stages):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES} and QUERIES.items() <= entry.queries().items()
    got = corpus_pipeline.run(spark, SF)
    pick = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r) for r in got.select(*pick).collect()) == sorted(tuple(r) for r in stages[5].select(*pick).collect())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), ORACLES[name], connect(SF)) == []


def test_the_rest_does_not_need_this_package():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("tidemark/**/*.py"), *root.glob("catalog/*.py")]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
