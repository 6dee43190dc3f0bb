"""Collocations against plain counting of all phrases."""

import pickle
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metrolens.llm import collocations


def slow(rows, support, longest=5):
    counts, sizes = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    f = {k: n for k, n in counts.items() if n >= support}
    covered = {}
    for (lang, p), n in f.items():
        for size in range(1, len(p)):
            for i in range(len(p) - size + 1):
                key = lang, p[i : i + size]
                covered[key] = max(covered.get(key, 0), n)
    out = []
    for (lang, p), a in f.items():
        if len(p) > 1 and covered.get((lang, p), 0) < a:
            cuts = [(f[lang, p[:k]], f[lang, p[k:]], k) for k in range(1, len(p))]
            score, _, l, r = min((1000 * a * sizes[lang] // (l * r), k, l, r) for l, r, k in cuts)
            out.append((lang, " ".join(p), len(p), a, l, r, sizes[lang], score))
    return sorted(out)


def found(docs, **options):
    rows = collocations.collocations(docs, **options)
    return sorted(tuple(r) for r in rows.select("lang", "phrase", "words", "a", "l", "r", "n", "score").collect())


def corpus(n=60, seed=5):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a", "A", "é", "É", "x\x1cy", "\x00", "long" * 20]
    fixed = ["new york city hall", "a a a a a a", "new  york\tcity", "once upon a time there was", "once upon a time"]
    rows = []
    for i in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for p in parts)
        rows.append((rnd.choice([i, 7, None]), text, rnd.choice(["en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("support,shards,bits", [(4, 3, 1 << 20), (10, 8, 1 << 10), (3, 50, 64), (1, 2, 1 << 20)])
def test_against_plain_counts(spark, documents, support, shards, bits):
    rows = corpus(60 if support > 1 else 12)
    docs = documents([(d, t, lang) for d, t, lang in rows]).repartition(3)
    want = slow(rows, support)
    assert found(docs, support=support, shards=shards, filter_bits=bits) == want
    assert want


def test_shards_find_every_frequent_phrase(spark, documents):
    """The union of what shards find, at their lowered supports, has no phrase too few."""
    rows = corpus(80, seed=9)
    texts = collocations._texts(documents(rows), "doc_id", "text", "lang", 4)
    filters, words = collocations.mine(texts, support=6, filter_bits=1 << 20)
    assert sum(words.values()) == sum(len(re.findall(r"[^ \t.,;:!?\x0a-\x0d]+", t.lower())) for _, t, _ in rows)
    assert len(words) > 1
    counted = {(r.lang, r.phrase): r.n for r in collocations.count_phrases(texts, filters).collect() if r.words}
    for lang, phrase, _, a, *_ in slow(rows, 6):
        assert counted[lang, phrase] == a


def test_only_phrases_that_reach_the_support_are_counted_again(spark, documents):
    """A phrase that is frequent in one shard alone is dropped by the counts of all shards."""
    rows = corpus(80, seed=9) + [(1000 + i, f"rare words{i} rare words{i} rare words{i}. " * 2, "en") for i in range(40)]
    texts = collocations._texts(documents(rows), "doc_id", "text", "lang", 8)
    support = 30
    filters, _ = collocations.mine(texts, support=support, filter_bits=1 << 20)
    counted = [r.n for r in collocations.count_phrases(texts, filters).collect() if r.words]
    assert counted and min(counted) >= support


def test_phrases_are_not_counted_again_in_every_task(spark, documents, monkeypatch):
    """Tasks hand on no row for each found phrase that they meet: found hashes carry exact counts already."""

    def again(*args):
        raise AssertionError("all texts read again for phrases that share no hash")

    monkeypatch.setattr(collocations, "count_phrases", again)
    rows = corpus(40, seed=3)
    assert found(documents(rows).repartition(8), support=4, filter_bits=1 << 20) == slow(rows, 4)


def mined(spark, documents, rows, support):
    texts = collocations._texts(documents(rows), "doc_id", "text", "lang", 3)
    filters, _, words, levels = collocations._mined(texts, support, 5, 1 << 20)
    return texts, filters, words, levels


def plain(rows, support):
    counts = Counter()
    for _, text, lang in rows:
        for piece in text.split("."):
            w = piece.split()
            counts.update((lang, n, " ".join(w[i : i + n])) for n in range(1, 6) for i in range(len(w) - n + 1))
    return {k: n for k, n in counts.items() if n >= support}


@pytest.mark.parametrize("which", ["phrase", "word"])
def test_phrases_that_share_a_hash_are_counted_by_their_words(spark, documents, which):
    rnd = random.Random(8)
    words = "red green blue the of and".split()
    rows = [(i, " ".join(rnd.choices([*words, "and."], k=40)), rnd.choice(["en", "fr"])) for i in range(30)]
    texts, filters, every, levels = mined(spark, documents, rows, 5)
    if which == "phrase":  # places of half of the hashes have two prefixes, and count too many
        other = F.col("hash") % 2 == 0
        levels[1] = levels[1].withColumn("lo", F.when(other, F.lit(-(1 << 63))).otherwise(F.col("lo")))
        levels[1] = levels[1].withColumn("n", F.when(other, F.col("n") + 1000).otherwise(F.col("n")))
        assert 0 < levels[1].filter("lo = hi").count() < levels[1].count()
    else:  # a rare word has the hash of a frequent one
        rare = every.filter("lang = 'en' AND word = CAST('the' AS BINARY)").limit(1)
        every = every.unionByName(rare.selectExpr("shard", "lang", "CAST('rare' AS BINARY) word", "1L n", "hash"))
    counts = collocations.exact_counts(texts, filters, every, levels, 1 << 20).filter("n >= 5").collect()
    assert {(r.lang, r.words, r.phrase): r.n for r in counts} == plain(rows, 5)
    assert len(counts) == len({(r.lang, r.words, r.phrase) for r in counts})


def test_every_count_carries_its_prefix():
    hashes, prefixes = np.array([7, 3, 7, 3, 7], np.uint64), np.array([1, 2, 1, 2, 5], np.uint64)
    counted = Counter()
    for h, p, n in zip(*(x.tolist() for x in collocations._counted(hashes, prefixes))):
        counted[h, p] += n
    assert counted == {(3, 2): 2, (7, 1): 2, (7, 5): 1}


def test_hash_and_prefix_give_the_last_word(spark):
    words = collocations.Words(b"new york city hall of the dead")
    pairs = words.longer(words.hashes, 2)
    back = collocations.unscrambled(pairs) - words.hashes[:-1] * np.uint64(collocations.STEP)
    assert (back == words.hashes[1:]).all()


def test_words_that_are_not_utf8_keep_their_phrases(spark, documents):
    docs = documents([(i, "x b c. x b c", "en") for i in range(6)])
    docs = docs.withColumn("text", F.expr("CAST(concat(X'FF', CAST(substring(text, 2) AS BINARY)) AS STRING)"))
    got = {(r.phrase, r.a) for r in collocations.collocations(docs, support=6).collect()}
    assert got == {("\ufffd b c", 6), ("b c", 12), ("x b c", 6)}


class Captured:
    """Stands in for a table of texts; keeps what its tasks would run."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def select(self, *columns):
        return self

    groupBy = agg = select


def test_counting_holds_little_memory(spark):
    """A task's working memory is that of its tables of phrases and of a piece of its texts."""
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=240)).encode() for _ in range(1600)]
    every = collocations.Filter(np.full(1, -1, np.int64).view(np.uint64))
    plan = Captured()
    collocations.count_phrases(plan, [every, every])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts, pa.binary())], names=["lang", "text"])
    counted, arrow = {}, 0
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for rows in plan.run(iter([batch])):
            arrow = max(arrow, pa.total_allocated_bytes() - before)
        peak = tracemalloc.get_traced_memory()[1] + arrow
    finally:
        tracemalloc.stop()
    assert peak < 100e6
    for rows in plan.run(iter([batch])):
        for size, phrase, n in zip(*(rows.column(c).to_pylist() for c in ("words", "phrase", "n"))):
            counted[size, phrase] = counted.get((size, phrase), 0) + n
    want = Counter()
    for text in texts:
        one = text.decode().split()
        want.update((1, w) for w in one)
        want.update((2, f"{a} {b}") for a, b in zip(one, one[1:]))
        want[0, ""] += len(one)
    assert counted == want


def test_a_filter_takes_the_room_of_what_it_holds(spark):
    hashes = spark.range(1000).select(F.xxhash64("id").alias("hash"))
    sieve = collocations.Filter.of(hashes, 1 << 26)
    assert len(pickle.dumps(sieve)) < 1 << 18
    inside = np.array([r.hash for r in hashes.collect()], np.int64).view(np.uint64)
    assert sieve.holds(inside).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    assert sieve.holds(others).mean() < 1 / collocations.ROOM


def test_phrases_that_are_not_utf8():
    every = collocations.Filter(np.full(1, -1, np.int64).view(np.uint64))
    texts = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([b"\xff a \xff"], pa.binary())], names=["lang", "text"])
    found = [r for rows in collocations.phrase_rows(iter([texts]), [every]) for r in rows.to_pylist()]
    assert sorted((r["words"], r["phrase"], r["n"]) for r in found) == [(0, "", 3), (1, "a", 1), (1, "\ufffd", 2)]


def test_long_words_and_blocks():
    text = b"A" * 3000 + b" b " + b"c" * 5000 + b", d e\tf." + b" A" * 4000
    whole, cut = collocations.Words(text), collocations.Words(text, block=100)
    assert (whole.hashes == cut.hashes).all()
    assert whole.last[:3].tolist() == [3, 2, 1] and whole.last[3:6].tolist() == [3, 2, 1]
    assert whole.hashes[6] == whole.hashes[-1] and whole.hashes[0] != whole.hashes[6]


def test_products_beyond_64_bits(spark, documents):
    """Scores stay exact where a * n and l * r pass 64 bits."""
    row = spark.range(1).selectExpr(
        "(1000 * cast(3000000000001 AS decimal(17,0)) * cast(90000000000007 AS decimal(17,0)))"
        " DIV (cast(3000000000011 AS decimal(17,0)) * cast(3000000000007 AS decimal(17,0))) AS s"
    )
    assert row.first().s == 1000 * 3000000000001 * 90000000000007 // (3000000000011 * 3000000000007)


def test_awkward(spark, documents, awkward):
    rows = [(d, t, lang) for d, t, lang, _ in awkward]
    docs = documents(awkward, extra=[("phrase", "p"), ("n", "1"), ("words", "w")])
    assert found(docs, support=2) == slow(rows, 2)
    assert found(documents([])) == []
    assert found(documents([(1, None), (2, "")]), support=1) == []
