"""Token files: exact round trip against the tokenizer, and the format itself."""

import random
import zlib

import numpy as np
import pytest

from metrolens.llm import token_files as tf


@pytest.fixture(scope="module")
def words():
    return tf.PartIds(tf.vocabulary_path())


def check(spark, docs, words, path, **options):
    tf.write_ids(docs, path, **options)
    got = tf.read_ids(spark, path).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*words.encoder.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(got, key=lambda r: r.start)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    names = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert names == sorted(names)  # ascending, null ids first
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]] if got else True
    return got


def test_round_trip(spark, words, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    got = check(spark, docs, words, str(tmp_path / "a"))
    slim = tf.read_ids(spark, str(tmp_path / "a"), ids=False)
    assert sorted(slim.collect()) == sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got)


def test_many_files_in_order_of_their_paths(spark, words, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    check(spark, docs, words, str(tmp_path / "a"), chunk_ids=5000)
    before = []
    files = sorted((tmp_path / "a" / tf.FILES).glob("file=*/part-*"))
    assert len(files) > 20
    for file in files:
        names, missing, lengths, ranks, start = tf.parse_file(file.read_bytes())
        assert lengths.sum() == len(ranks) and not missing.any()
        before.append((start, int(names[0]), int(names[-1])))
    assert before == sorted(before) and all(a[2] < b[1] for a, b in zip(before, before[1:]))


def test_ranks_follow_frequency(spark, words, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tf.write_ids(docs, str(tmp_path / "a"))
    (ranks,) = (tmp_path / "a" / tf.RANKS).glob("part-*")
    by_rank = np.frombuffer(ranks.read_bytes()[:-1], "<u4")
    counts = np.zeros(60_000, np.int64)
    for r in docs.collect():
        ids, n = np.unique([*words.encoder.encode(r.text, add_special_tokens=False).ids, 2], return_counts=True)
        counts[ids] += n
    assert by_rank.tolist() == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))


def test_awkward(spark, documents, awkward, words, tmp_path):
    check(spark, documents(awkward, extra=[("ids", "x"), ("part", "y"), ("total", "z")]), words, str(tmp_path / "a"))
    check(spark, documents(awkward).repartition(4), words, str(tmp_path / "b"), chunk_ids=1)
    assert check(spark, documents([]), words, str(tmp_path / "c")) == []
    check(spark, documents([(None, None)] * 5), words, str(tmp_path / "d"))


def test_parts_are_encoded_as_the_whole(words):
    rnd = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "é", "'s", "'ll", "'", "1", "23", "!", "?!", "\xa0", "　", "中", "и"]
    parts += ["\U0001f600", "\x1c", "\x85", "\x00", "’", "<|endoftext|>", "_", "ß", "ŉ", "​", "\r\n", "ʼ", "ª", "×"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 10))) for _ in range(20_000)]
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], words.texts(texts[at : at + 500])):
            assert ids == words.packed(words.encoder.encode(text, add_special_tokens=False).ids), repr(text)


def test_parts_beyond_those_held(words, monkeypatch):
    monkeypatch.setattr(tf, "HELD_PARTS", 50)
    few = tf.PartIds(tf.vocabulary_path())
    texts = [f"some word{i} other{i % 7} thing, and word{i}s!" for i in range(300)]
    for at in range(0, 300, 20):
        assert few.texts(texts[at : at + 20]) == words.texts(texts[at : at + 20])
    assert len(few) < 200


def test_numbers():
    rnd = random.Random(1)
    edges = [0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]
    for n in [0, 1, 2, 3, 4, 5, 1003]:
        values = np.array([rnd.choice(edges) for _ in range(n)], "<u4")
        control, data = tf.put_numbers(values)
        assert len(control) == -(-n // 4)
        assert len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in values)
        assert (tf.get_numbers(control, data, n, block=7) == values).all()


def test_other_files_are_refused(spark, documents, tmp_path):
    with pytest.raises(ValueError, match="not a file"):
        tf.parse_file(b"x" * 200)
    tf.write_ids(documents([(1, "some words here")]), str(tmp_path / "a"))
    (file,) = (tmp_path / "a" / tf.FILES).glob("file=*/part-*")
    with pytest.raises(ValueError, match="cut off"):
        tf.parse_file(file.read_bytes()[:-3])
