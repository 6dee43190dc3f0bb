import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from sql import rows, rows_of  # noqa: E402

from metrolens.llm import mixing  # noqa: E402
from metrolens.session import materialize  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def counts(docs, **options):
    held = docs.select(
        F.monotonically_increasing_id().alias("k"), "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    held = materialize(held, "test-mix")
    return mixing.mix_counts(held, "k", "doc_id", "source", "size", **options)


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Share out by weight and clamp, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(sizes.values())
    full = set()
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: epochs * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] >= epochs * sizes[s]}
        if not over:
            return target
        full |= over
        if len(full) == len(names):
            return {s: epochs * sizes[s] for s in names}


def check(docs, **options):
    source = {r.doc_id: r.source for r in docs.collect()}
    got = counts(docs, **options).collect()
    assert len(got) == docs.count()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        s = source[r["__id"]]
        sizes[s] += r["__words"]
        taken[s] += r["__words"] * r["__copies"]
        longest[s] = max(longest[s], r["__words"])
        assert 0 <= r["__copies"] <= 2
    want = slow_targets(dict(sizes)) if sizes else {}
    for r in got:
        s = source[r["__id"]]
        assert r["__size"] == sizes[s]
        assert r["__target"] == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6


def test_targets_are_met(documents):
    rows_ = [(i, "w " * (i * 37 % 91), None, [None, "a", "b", "é", "Z"][i * i % 5]) for i in range(400)]
    rows_ += [(1000 + i, "w " * 500, None, "hot") for i in range(100)]
    check(documents(rows_))


def test_awkward_rows(documents, awkward):
    docs = documents([r for r in awkward if r[0] is not None], [("__key", "a"), ("size", "b"), ("target", "c")])
    check(docs)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in docs.collect()}


def test_null_ids_and_empty_tables(documents, awkward):
    assert counts(documents(awkward)).count() == len(awkward)
    assert counts(documents([])).count() == 0
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None), (2, "")])).count() == 0


def test_reruns_agree_and_the_seed_matters(documents):
    docs = documents([(i, "w " * (i % 17 + 1), None, f"s{i % 3}") for i in range(300)])
    one = rows(counts(docs), "__id", "__copies")
    assert one == rows(counts(docs.repartition(7)), "__id", "__copies")
    assert one != rows(counts(docs, seed=1), "__id", "__copies")


def test_repeated_rows_are_taken_one_by_one(documents):
    docs = documents([(7, "one two three", None, "a")] * 90 + [(8, "w " * 3000, None, "b")])
    got = [r for r in counts(docs).collect() if r["__id"] == 7]
    taken = sum(r["__words"] * r["__copies"] for r in got)
    assert abs(taken - got[0]["__target"]) <= 1.5


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows(mixing.op10_mixing(spark, sf)) == rows_of(mixing.oracle_sql(), documents=docs)
