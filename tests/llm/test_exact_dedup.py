import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metrolens.llm.exact_dedup import PatriciaTrie, drop_copies, find_copies


def expected(rows, largest=True):
    """Sorted (doc_id, keep_id, group_size, sha256) and how many rows stay."""
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    pick = max if largest else min
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = pick(named) if named else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str), len(groups)


def check(found, rows, largest=True):
    want, groups = expected(rows, largest)
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups
    assert len({r.text_sha256 for r in kept}) == groups
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_awkward_rows(documents, awkward, keep):
    check(find_copies(documents(awkward), keep=keep), awkward, keep == "largest")


def test_flushed_and_spilled_tries_give_the_same_result(documents):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(14)))) for i in range(3000)]
    rows += [(5000 + i, "hot text " * 30) for i in range(1500)]
    check(find_copies(documents(rows).repartition(6), scan_bytes=4_000, owner_bytes=20_000), rows)


def test_one_copy_stays_with_all_its_columns(documents, awkward):
    extra = [("__copy", "u"), ("__kept", "v"), ("keep_id", "w"), ("__m0", "x")]
    docs = documents(awkward, extra)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    got = left.collect()
    assert len(got) == expected(awkward)[1]
    assert {tuple(r) for r in got} <= {tuple(r) for r in docs.collect()}
    # the empty text of the largest id stays: row 2, not the null of row 1
    assert [r.doc_id for r in got if r.text == ""] == [2] and not [r for r in got if r.text is None]


def test_empty_table(documents):
    assert find_copies(documents([])).count() == 0
    assert drop_copies(documents([])).count() == 0


@given(st.lists(st.binary(max_size=12), max_size=60))
@settings(max_examples=200, deadline=None)
def test_trie_holds_exactly_its_texts(texts):
    trie = PatriciaTrie()
    for text in texts:
        node = trie.find(text)
        node.entry = (node.entry or 0) + 1
    assert dict(trie.items()) == {t: texts.count(t) for t in texts}


@given(st.lists(st.binary(max_size=8), max_size=60), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_spilled_subtrees_lose_nothing(texts, every):
    trie, out = PatriciaTrie(), []
    for i, text in enumerate(texts):
        node = trie.find(text)
        if node is None:
            out.append(text)
        else:
            node.entry = (node.entry or 0) + 1
        if i % every == 0:
            out += [t for t, n in trie.spill() for _ in range(n)]
    kept = {t: n for t, n in trie.items() if n}
    assert not set(kept) & set(out)
    assert sorted([t for t, n in kept.items() for _ in range(n)] + out) == sorted(texts)
