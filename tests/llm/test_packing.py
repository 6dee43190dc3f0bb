import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from metrolens.llm.packing import WordIds, pack_documents, place, plan_windows, vocabulary_path

PATH = vocabulary_path()
ENCODER = Tokenizer.from_file(PATH)
WORDS = WordIds(PATH)


def ids_of(text):
    return ENCODER.encode(text or "", add_special_tokens=False).ids + [2]


def check(found, rows, window):
    """Every id once, in order; sequences without gaps; padding only as allowed."""
    got = found.collect()
    want = {}
    for doc_id, text, *_ in rows:
        want.setdefault((doc_id, tuple(ids_of(text))), []).append(1)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for (doc_id, ids), copies in want.items():
        mine = [r for r in by_doc[doc_id] if r.doc_tokens == len(ids)]
        covered = np.zeros(len(ids), int)
        for r in mine:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            covered[r.start : r.start + r.length] += 1
        same = sum(len(c) for (d, i), c in want.items() if d == doc_id and len(i) == len(ids))
        assert (covered == same).all()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0


@pytest.mark.parametrize("window", [16, 4096])
def test_awkward_rows(documents, awkward, window):
    check(pack_documents(documents(awkward, [("piece", "a"), ("ids", "b")]), window=window), awkward, window)


def test_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(pack_documents(docs), rows, 4096)


@pytest.mark.parametrize("window", [16, 4096])
def test_sequences_hold_their_ids(documents, window):
    """The ids come with their places, cut pieces included; the digest is that of the call without ids."""
    rows = [(i, " ".join(f"word{i} number {j}" for j in range(3 * i))) for i in range(12)]
    docs = documents(rows)
    got = pack_documents(docs, window=window).collect()
    again: dict[int, list[int]] = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        part = np.frombuffer(r.ids, f"<u{len(r.ids) // r.length}")
        assert len(part) == r.length and zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32
        again.setdefault(r.doc_id, []).extend(part.tolist())
    assert again == {i: ids_of(text) for i, text in rows}
    bare = pack_documents(docs, window=window, ids=False)
    assert "ids" not in bare.columns
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, bare.collect())) == sorted(map(key, got))


def test_empty_table(documents):
    assert pack_documents(documents([])).count() == 0


@given(st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(WORDS.texts([text])[0], "<u4").tolist() == ENCODER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "It's we'll THEY'RE don't 12three 4½ ª² naïve ÉCOLE İstanbul",
        "ΑΣ ΣΑΣ Σ. é K ẞ",
        "a b c d\x85e\x1cf\x0bg",
        "<|endoftext|> x<|startoftext|>y <|endoftext",
        "日本語 text 🙂🙃 ­ soft",
        "%%% ### the%%% http://a.b/c?d=e&f",
    ],
)
def test_special_texts(text):
    assert np.frombuffer(WORDS.texts([text])[0], "<u4").tolist() == ENCODER.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 32), max_size=80))
@settings(max_examples=300, deadline=None)
def test_every_piece_has_one_place(lengths):
    window = 32
    histogram = np.bincount(np.array(lengths, int), minlength=window + 1) if lengths else np.zeros(window + 1, int)
    plan = plan_windows(histogram, window)
    length = np.repeat(np.arange(window + 1), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram]) if lengths else np.zeros(0, int)
    at, skip, part, number, offset = place(length.astype(np.int64), rank.astype(np.int64), plan)
    covered = {}
    for i, s, p in zip(at, skip, part):
        covered.setdefault(i, []).append((s, p))
    assert len(covered) == len(length)
    for i, parts in covered.items():
        end = 0
        for s, p in sorted(parts):
            assert s == end and p > 0
            end += p
        assert end == length[i]
    filled = {}
    for n, o, p in zip(number, offset, part):
        filled.setdefault(n, []).append((o, p))
    for parts in filled.values():
        end = 0
        for o, p in sorted(parts):
            assert o == end
            end += p
        assert end == window or end & (end - 1) == 0


def test_recipes_take_most_of_a_regular_histogram():
    histogram = np.zeros(4097, int)
    histogram[[1000, 3096, 2048, 1500, 2596, 4096]] = [900, 1000, 501, 400, 390, 7]
    plan = plan_windows(histogram)
    assert plan["used"][4096] == 7
    assert plan["used"].sum() >= 0.9 * histogram.sum()


def test_recipes_carry_most_tokens(spark):
    """The greedy rest is small where the histogram is that of real documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = np.array([len(i) // 4 + 1 for i in WORDS.texts([r.text for r in docs.select("text").collect()])])
    pieces = np.concatenate([lengths % 4096, np.full((lengths // 4096).sum(), 4096)])
    histogram = np.bincount(pieces, minlength=4097)
    histogram[0] = 0
    plan = plan_windows(histogram)
    share = (plan["used"] * np.arange(4097)).sum() / (histogram * np.arange(4097)).sum()
    assert share > 0.7, share


def test_words_beyond_those_held(monkeypatch):
    from metrolens.llm import packing

    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    monkeypatch.setattr(packing, "CACHED_PIECES", 20)
    few = WordIds(PATH)
    texts = [f"Some word{i}, other-{i % 7} thing und wörter{i}s!" for i in range(200)]
    for at in range(0, 200, 20):
        assert few.texts(texts[at : at + 20]) == WORDS.texts(texts[at : at + 20])
    assert len(few) < 200 and len(few.pieces) < 200


def test_words_are_put_together_from_held_parts(monkeypatch):
    """Different words of the same sub-words are no work of their own, whichever way their bytes are cut."""
    parts = WordIds(PATH)
    texts = [f"one{a}two{b}-THREE{a}.{b} don't{a % 3} naïve " + "x" * (b % 20) + f" {'=' * (a + b)}" for a in range(40) for b in range(40)]
    got = parts.texts(texts)
    assert len(parts) < 100 and len(parts.pieces) < 200
    seen = []
    monkeypatch.setattr(parts, "learned", lambda spans, odd: seen.extend(spans) or [])
    assert parts.texts(texts) == got and seen == []
    for text, ids in list(zip(texts, got))[::97]:
        assert ids == np.array(ENCODER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB'sStT .-\x00\x01\t\n\x7f19éÀß́  漢İΣ<|>"), max_size=40), max_size=5))
def test_odd_words_beside_plain_ones(texts):
    for got, text in zip(WORDS.texts(texts), texts):
        assert got == np.array(ENCODER.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_spans_of_one_hash(monkeypatch):
    from metrolens.llm.packing import SpanTable

    monkeypatch.setattr(SpanTable, "mixed", staticmethod(lambda one, two: one * np.uint64(0)))
    few = WordIds(PATH)
    texts = ["some words of one hash", "and some others, 12 of them", "some words of others"]
    assert few.texts(texts) == WORDS.texts(texts) == few.texts(texts)
