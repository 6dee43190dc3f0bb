import zlib

import numpy as np
from pyspark.sql import functions as F

from metrolens.llm import language


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in language.op7_language(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in docs)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_counts_against_plain_loops():
    text = "Hé, 3 ça!"
    words = [b"h\xc3\xa9", b"\xc3\xa7a"]
    line = b" " + b" ".join(words) + b" "
    want = np.zeros(language.BUCKETS)
    for order in language.ORDERS:
        for i in range(len(line) - order + 1):
            gram = line[i : i + order]
            if b" " in gram[1:-1]:
                continue
            h = 0
            for b in gram:
                h = (h * 0x01000193 + b) % 2**32
            want[((h + order) * 0x9E3779B1 % 2**32 >> 15) % language.BUCKETS] += 1
    assert (language.subword_counts(text) == want).all()


def test_awkward_rows(documents, awkward):
    docs = documents(awkward, [("score", "a"), ("LANG_PRED", "b"), ("rejected", "c")])
    model = language.train(docs, F.lit(True))
    assert set(model["classes"]) == {"en", "la"}
    found = language.with_language(docs, model)
    assert found.columns[: len(docs.columns)] == docs.columns
    got = found.collect()
    assert len(got) == len(awkward)
    at = len(docs.columns)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r[at] == "und") == (not letters) and 0 <= r[at + 1] <= 1
    assert [r.text for r in got] == [r[1] for r in awkward]


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "abc"), (2, None)])
    assert language.train(docs, F.lit(True)) is None
    got = language.with_language(docs, None).collect()
    assert [r.lang_pred for r in got] == ["und", "und"]
    assert language.with_language(documents([]), None).count() == 0


def test_reruns_and_other_partitions_agree(spark, documents):
    rows = [(i, ("the and of " if i % 2 else "der und von ") * (1 + i % 7), "en" if i % 2 else "de") for i in range(80)]
    one = language.train(documents(rows), F.lit(True))
    two = language.train(documents(rows[::-1]).repartition(5), F.lit(True))
    assert np.array_equal(one["logits"], two["logits"]) and one["heat"] == two["heat"]


def test_rejection_keeps_the_trusted():
    scores = np.array([0.9, 0.8, 0.7, 0.6])
    assert language.rejection_score(scores, np.array([True, True, True, False])) == 0.7
    assert language.rejection_score(scores, np.array([False] * 4)) == 1.0
