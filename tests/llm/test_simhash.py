import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from metrolens.llm.common import connected_components
from metrolens.llm.simhash import fingerprint, keep_one, links, near_duplicates, segment_widths, spanning_links


def slow_print(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance):
    """Root by union-find over all pairs of the given (unsigned) fingerprints."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def check(found, rows, distance=3):
    prints = [slow_print(t) for _, t, *_ in rows]
    roots = slow_components(prints, distance)
    ids = {}
    for (doc_id, *_), root in zip(rows, roots):
        if doc_id is not None:
            ids[root] = min(doc_id, ids.get(root, doc_id))
    want = sorted(((r[0], f"{p:016x}", ids.get(root)) for r, p, root in zip(rows, prints, roots)), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()), key=str)
    assert got == want


def near_rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            text = rng.choice(rows)[1].split(" ")
            text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [rng.choice(words) for _ in range(rng.randrange(1, 150))]
        rows.append((i, " ".join(text)))
    return rows


def test_awkward_rows(documents, awkward):
    check(near_duplicates(documents(awkward)), awkward)


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_against_all_pairs(documents, distance):
    rows = near_rows(distance, 150)
    check(near_duplicates(documents(rows), distance=distance), rows, distance)


def test_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(near_duplicates(docs), rows)


def flipped(rng, base, k):
    for b in rng.sample(range(64), k):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("block", [3, 20_000])
def test_dense_and_sparse_fingerprints(spark, block):
    """Chains, a dense cluster and far points; small blocks split the hot keys."""
    rng = random.Random(block)
    prints = {rng.getrandbits(64) for _ in range(60)}
    hub = rng.getrandbits(64)
    prints |= {flipped(rng, hub, rng.randrange(5)) for _ in range(120)}
    at = rng.getrandbits(64)
    for _ in range(40):
        at = flipped(rng, at, 3)
        prints.add(at)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, block)
    found = {r.node: r.root for r in connected_components(edges).collect()}
    roots = slow_components(prints, 3)
    groups, got = {}, {}
    for p, root in zip(signed, roots):
        groups.setdefault(root, set()).add(p)
        got.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_spanning_links_make_a_forest():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(-(2**63), 2**63 - 1, 50) & ~np.int64(0xFF))
    prints = np.unique(np.concatenate([prints, prints ^ 1, prints ^ 7, np.array([-1, -2])]))
    edges = spanning_links(prints, 3)
    assert len(edges) < len(prints)
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 3 for u, v in edges)


def test_one_of_each_group_stays(documents, awkward):
    docs = documents(awkward + [(20 + i, t) for i, t in near_rows(1, 60)], [("__row", "a"), ("fp", "b")])
    rows = docs.collect()
    left = keep_one(docs)
    assert left.columns == docs.columns
    prints = [slow_print(r.text) for r in rows]
    roots = slow_components(prints, 3)
    assert left.count() == len(set(roots))
    ids = sorted((r.doc_id for r in left.collect()), key=str)
    want = {}
    for r, root in zip(rows, roots):
        key = (r.doc_id is None, r.doc_id)
        want[root] = min(want.get(root, key), key, key=lambda k: (k[0], k[1] or 0))
    assert ids == sorted((i for _, i in want.values()), key=str)


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert keep_one(documents([])).count() == 0


def test_widths_and_single_words():
    assert [sum(segment_widths(k)) for k in range(9)] == [64] * 9
    for text in ("a", "A b", "a b c", "é É", None, " "):
        assert fingerprint(text.encode() if text else None, 3, 42) & (2**64 - 1) == slow_print(text)
