import zlib

import numpy as np
from pyspark.sql import functions as F

from metrolens.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op8_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in labels if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in labels)
    assert np.mean([got[r.doc_id].predicted == r.quality for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    x, bag = rng.normal(size=(7, quality.FEATURES)), np.array([0, 0, 1, 1, 1, 2, 2])
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fit(x.astype(np.float32), bag, y)
    model["w"] = rng.normal(size=quality.ATTENTION)

    def loss(m):
        p = quality.forward(m, x, bag, 3)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = quality._gradients(model, x, bag, y)
    for name in ("W", "V", "U", "w", "c", "b"):
        at = np.unravel_index(5 % model[name].size, model[name].shape)
        up, down = ({k: np.array(v) for k, v in model.items()} for _ in range(2))
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        decay = 1e-5 * model[name][at]
        assert abs((loss(up) - loss(down)) / 2e-6 + decay - grads[name][at]) < 1e-6


def test_passages_cover_the_whole_text():
    for n in (0, 1, 3, 511, 512, 1500, 200_000):
        rows = quality.passages(b"a" * n)
        assert rows.shape == (min(quality.PASSAGES, max(1, n // 512)), quality.FEATURES)
        assert np.isfinite(rows).all()
    start, end = b"!" * 600 + b"a" * 40_000, b"a" * 40_000 + b"!" * 600
    assert (quality.passages(start)[0] != quality.passages(end)[0]).any()
    assert (quality.passages(start)[-1] != quality.passages(end)[-1]).any()


def test_long_texts_keep_short_passages():
    """Every 512 bytes of a text of any length are a passage, and each counts in the score."""
    rng = np.random.default_rng(3)
    text = bytes(rng.choice(np.frombuffer(b"abcd  \n", np.uint8), 300_001)) + b"x" * 70_000 + b" xy xy xy"
    whole = next(quality.every_passage(text, 10**6))
    parts = list(quality.every_passage(text))
    assert len(whole) == len(text) // 512 and all(len(x) <= quality.AT_ONCE for x in parts)
    np.testing.assert_array_equal(np.concatenate(parts), whole)
    np.testing.assert_array_equal(quality.passages(text)[[0, -1]], whole[[0, -1]])
    # the features of a passage do not depend on the length of the document, but for the document's own size
    np.testing.assert_array_equal(next(quality.every_passage(text[:20_480]))[:39, :-1], whole[:39, :-1])

    y = np.array([1.0, 0.0, 1.0, 0.0])
    bags = [quality.passages(t) for t in (text[:5000], b"!?" * 4000, text[:9000], b"!?" * 900)]
    model = quality.fit(np.concatenate(bags), np.repeat(np.arange(4), [len(b) for b in bags]), y)
    expected = quality.forward(model, whole, np.zeros(len(whole), np.int64), 1)["score"][0]
    got = quality.score_texts(model, [b"", text, text[:100]])
    assert abs(got[1] - expected) < 1e-9
    # A strange stretch of a passage's size in a text beyond 32 KiB is seen as such.
    long = text[:200_000]
    marked = long[:102_400] + b"!" * 512 + long[102_912:]
    x = np.concatenate(list(quality.every_passage(marked)))
    assert (x[:, 7 + quality.SIGNS.index(ord("!"))] == 1).sum() == 1


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_awkward_rows(spark, documents, awkward):
    docs = documents(awkward, [("Score", "a"), ("predicted", "b"), ("label", "c")])
    labels = labels_of(spark, [(2, 0, 0), (4, 1, 0), (4, 0, 0), (6, 1, 1), (7, 1, None), (None, 1, 0), (8, None, 0)])
    model = quality.train(docs, labels, F.lit(True))
    assert "W" in model
    found = quality.with_quality(docs, model)
    got = found.collect()
    assert len(got) == len(awkward) and all(0 <= r[-1] <= 1 for r in got)
    assert quality.accepted(docs, model, cut=0.0).columns == docs.columns
    assert quality.accepted(docs, model, cut=0.0).count() == len(awkward)


def test_labels_of_one_kind_or_none(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    assert quality.train(docs, labels_of(spark, []), F.lit(True)) == {"constant": 0.5}
    assert quality.train(docs, labels_of(spark, [(1, 1, 0)]), F.lit(True)) == {"constant": 1.0}
    assert [r.score for r in quality.with_quality(docs, {"constant": 0.5}).collect()] == [0.5, 0.5]
    assert quality.accepted(documents([]), {"constant": 0.5}).count() == 0
