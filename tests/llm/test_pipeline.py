"""Every stage of the pipeline on its own input against plain Python."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_mixing import slow_targets  # noqa: E402
from test_packing import check as check_packing  # noqa: E402
from test_simhash import slow_components, slow_print  # noqa: E402

import corpus_pipeline  # noqa: E402
from metrolens.llm import quality  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.collect()]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        step(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.collect())
    return seen


def test_quality(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = {r.doc_id: r for r in quality.op8_quality(spark, SF).collect()}
    assert sorted(steps[1]) == sorted(r for r in steps[0] if scored[r.doc_id].predicted)
    assert 0 < len(steps[1]) < docs.count()
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1]}
    assert sum(i in kept for i, q in marks.items() if q == 1) >= 0.95 * sum(marks.values())


def test_exact(steps):
    best = {}
    for r in steps[1]:
        best[r.text] = max(best.get(r.text, r), r, key=lambda d: d.doc_id)
    assert sorted(steps[2]) == sorted(best.values())


def test_near(steps):
    rows = sorted(steps[2], key=lambda r: r.doc_id)
    roots = slow_components([slow_print(r.text) for r in rows], 3)
    assert sorted(steps[3]) == sorted(rows[i] for i in set(roots))


def test_mixed(steps):
    sizes, taken, longest = Counter(), Counter(), Counter()
    words = {r.doc_id: len(r.text.split()) for r in steps[3]}
    for r in steps[3]:
        sizes[r.source] += words[r.doc_id]
        longest[r.source] = max(longest[r.source], words[r.doc_id])
    for r in steps[4]:
        taken[r.source] += words[r.doc_id]
    want = slow_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 for s in sizes)
    copies = Counter(steps[4])
    assert set(copies) <= set(steps[3]) and max(copies.values()) <= 2


def test_packed(spark, steps):
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    found = spark.createDataFrame(steps[5], schema)
    check_packing(found, [(r.doc_id, r.text) for r in steps[4]], 4096)


def test_run_is_the_stages_in_turn(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got.collect())) == sorted(map(key, steps[5]))


def test_stages_take_awkward_documents(spark, documents, awkward):
    docs = documents(awkward, [("__row", "a"), ("score", "b"), ("__copy", "c"), ("__words", "d")])
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= len(awkward)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, documents([]), SF).count() == 0
