"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from metrolens.llm import spelling
from metrolens.plans import executed_join_nodes


def slow_words(rows, dropped=97):
    counts = Counter()
    for doc, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if dropped and h % dropped == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in spelling.variants(docs, **options).collect()), key=str)


@pytest.mark.parametrize("dropped", [97, 5, None])
def test_against_all_pairs(spark, documents, dropped):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(4, 8))) for _ in range(120)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "Ababab", "ÀBCDEÉ", "àbcdeé", "÷×÷×÷", "÷×÷×÷×"]
    rows = [(i, " ".join(rnd.choice(words[: rnd.choice((10, 130))]) for _ in range(60))) for i in range(60)]
    want = slow_variants(slow_words(rows, dropped))
    assert found(documents(rows), dropped=dropped) == want
    assert any(r[1] for r in want) and any(r[4] == 0 for r in want)


def test_long_chain(spark, documents):
    # every word is one letter from the one before it and twice as common
    text = " ".join(f"{'x' * 12}{'y' * i}{'z' * (9 - i)} " * (3 << i) for i in range(10))
    rows = [(1, text)]
    want = slow_variants(slow_words(rows, None))
    assert found(documents(rows), dropped=None) == want
    assert len({r[2] for r in want}) == 1


def test_awkward(spark, documents, awkward):
    docs = documents(awkward, extra=[("word", "w"), ("n", "1"), ("key", "k")])
    want = slow_variants(slow_words([r[:2] for r in awkward]))
    assert found(docs) == want
    assert found(documents([])) == []
    assert found(documents([(1, None), (2, ""), (3, "some words")])) == []


def test_pivots_come_from_the_prefix_and_do_not_overlap():
    rnd = random.Random(3)
    for _ in range(500):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(5, 10)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)}, key=lambda g: rnd.random())
        order = {g: i for i, g in enumerate(grams)}
        prefix, (a, b), last = spelling.prefix_and_pivots(word, order)
        rank = lambda i: order[word[i : i + 2]]
        assert prefix == [i for i in range(len(word) - 1) if rank(i) <= last] and len(prefix) >= 3
        pairs = [(rank(i) + rank(j)) for i in prefix for j in prefix if j - i >= 2]
        assert {a, b} <= set(prefix) and b - a >= 2 and rank(a) + rank(b) == min(pairs)


def test_no_table_of_words_is_broadcast(spark, documents, monkeypatch):
    """However small the planner takes a side to be: what it sees are packed files, and no rows per word."""
    joins = []

    def staged(df, name):
        rows = df.collect()
        joins.append((name, executed_join_nodes(df)))
        return spark.createDataFrame(rows, df.schema)

    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    monkeypatch.setattr(spelling, "materialize", staged)
    out = spelling.variants(documents([(1, "letter " * 20 + "lettter " * 8 + "leter " * 4 + "other " * 3)]), dropped=None)
    assert [r.root for r in out.collect()].count("letter") == 3
    joins.append(("out", executed_join_nodes(out)))
    assert {"spelling-pairs", "spelling-forms", "spelling-roots", "out"} == {name for name, nodes in joins if nodes}
    assert {node for _, nodes in joins for node in nodes} == {"SortMergeJoin"}


def test_short_words_are_refused(documents):
    with pytest.raises(ValueError):
        spelling.variants(documents([]), shortest=4)
