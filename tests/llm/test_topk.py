import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from sql import rows, rows_of  # noqa: E402

from metrolens.llm import topk  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, v string, norm string"


def slow(data, k, every):
    usable = set()
    for vec_id, x in data:
        if vec_id is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        usable.add((vec_id, tuple(math.floor(256 * float(np.float32(c))) for c in x)))
    out = []
    for q, a in usable:
        if q % every:
            continue
        best = sorted(
            (-sum(s * t for s, t in zip(a, b)), i) for i, b in usable if i != q and len(b) == len(a)
        )[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def found(spark, data, k=5, every=3):
    table = spark.createDataFrame([(i, x, 0, "a", "b") for i, x in data], SCHEMA)
    got = topk.top_k(table, F.col("id") % every == 0, k=k).collect()
    return sorted((r.query_id, r.rank, r.id, r.score) for r in got)


def vectors(seed, n, dim, centers=6, spread=0.3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centers, dim))
    return [(i, [float(v) for v in c[i % centers] + spread * rng.normal(size=dim)]) for i in range(n)]


def test_clusters_in_many_small_trees(spark, monkeypatch):
    monkeypatch.setattr(topk, "TREE_ROWS", 60)
    monkeypatch.setattr(topk, "PAGE", 8)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 40)
    monkeypatch.setattr(topk, "ROOT_BLOCK", 3)
    data = vectors(1, 500, 8) + [(1000 + i, [0.5] * 8) for i in range(90)] + [(2000 + i, [0.0] * 8) for i in range(9)]
    assert found(spark, data) == slow(data, 5, 3)


def test_awkward_rows(spark):
    data = vectors(2, 60, 4) + [
        (None, [1.0, 2.0, 3.0, 4.0]),
        (102, None),
        (105, [1.0, None, 0.0, 0.0]),
        (108, [1.0, float("nan"), 0.0, 0.0]),
        (111, [1.0, float("inf"), 0.0, 0.0]),
        (114, [1.0, 2.0]),
        (117, [2.0, 2.0]),
        (120, []),
        (123, [-0.0, 0.0, 0.001, -0.001]),
        (3, [9.0, 9.0, 9.0, 9.0]),
    ]
    data += data[:5]
    assert found(spark, data) == slow(data, 5, 3)


def test_ids_on_several_vectors(spark, monkeypatch):
    """A query's own other vectors do not take the places of its k best."""
    monkeypatch.setattr(topk, "TREE_ROWS", 20)
    data = vectors(4, 80, 4) + [(3, [9.0 + i, 9.0, 9.0, 9.0]) for i in range(7)] + [(6, [9.0, 9.0, 9.0, 9.0])]
    got = found(spark, data)
    assert got == slow(data, 5, 3)
    assert sum(r[0] == 3 for r in got) == 5 * 8


def test_fewer_rows_than_asked_and_none(spark):
    assert found(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 512 * 256), (3, 1, 0, 512 * 256)]
    assert found(spark, []) == []


def test_large_components_stay_exact(spark):
    data = [(i, [1e13 + i * 1e7, -3e12 + i]) for i in range(9)]
    assert found(spark, [(i, [x * 1e-6 for x in v]) for i, v in data]) == slow(
        [(i, [x * 1e-6 for x in v]) for i, v in data], 5, 3
    )


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert rows(topk.op9_topk(spark, sf)) == rows_of(topk.ORACLE_SQL, embeddings=table)


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_finds_what_a_scan_finds(seed):
    rng = random.Random(seed)
    x = np.floor(256 * np.array([v for _, v in vectors(seed, 800, 6, spread=0.05)]))
    x = np.unique(x, axis=0)
    top = float((x * x).sum(axis=1).max())
    pages, radius = topk.build_pages(x, [[i] for i in range(len(x))], top, page=16)
    assert sorted(i for p in pages if p.leaf for (i,) in p.ids) == list(range(len(x)))
    points = topk.lifted(x, top)
    for p in pages:  # covering radii hold all points below
        if not p.leaf:
            for r, child in zip(p.x, p.child):
                assert child > 0 and len(pages[child].x)
    q = x[[rng.randrange(len(x)) for _ in range(20)]]
    s = (q @ x.T).astype(np.int64)
    want = [sorted(range(len(x)), key=lambda i: (-row[i], i))[:6] for row in s]
    none = np.full(20, topk.NOTHING)
    got = topk.search(pages, radius, x[0], q, 6, top, none)
    assert got.id.tolist() == want
    assert got.score.tolist() == [[int(row[i]) for i in w] for row, w in zip(s, want)]
    known = np.array([row[w[-1]] for row, w in zip(s, want)])
    again = topk.search(pages, radius, x[0], q, 6, top, known)
    for row, w, ids, k in zip(s, want, again.id.tolist(), known):
        assert set(ids) >= {i for i in w if row[i] > k}
    assert points.shape[1] == 7
