import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from sql import rows, rows_of  # noqa: E402

from metrolens.llm import licenses  # noqa: E402


def query(docs):
    return licenses.label_documents(docs)


def slow(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License. mit LICENSE; mit-license mitlicense mité license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0 apache license apache license",
    "general general public license general public public license",
    "Licensed under CC BY-NC 4.0.",
    "Kelvin K mit\x7flicense mit\xa0license İ MIT\tLicense",
    "mit license " * 3000,
    "a",
]


def test_places_against_a_plain_scan(documents, awkward):
    rows_ = awkward + [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = documents(rows_, [("row", "a"), ("label", "b"), ("template", "c")])
    got = rows(query(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    names = sorted(["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"])
    want = []
    for doc_id, text, *_ in rows_:
        row = dict(zip(["n_words", "n_base", "first_word", "last_word", "base_labels"], slow(text)), doc_id=doc_id)
        want.append(tuple(row[n] for n in names))
    assert got == sorted(want, key=str)


def test_sql_agrees(spark, documents):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows(licenses.op2_licenses(spark, sf)) == rows_of(licenses.oracle_sql(), documents=docs)
    docs = documents([(i, t) for i, t in enumerate(TEXTS)])
    assert rows(query(docs)) == rows_of(licenses.oracle_sql(), documents=docs)


MIT = next(t for t, label in licenses.NOTICES.items() if label == "mit")


@pytest.mark.parametrize(
    "text,labels",
    [
        (f"x y {MIT} z", "mit"),
        (" ".join(w for i, w in enumerate(MIT.split()) if i not in (5, 12)), "mit"),
        (MIT.replace("free of charge", "free of any charge at all"), "mit"),
        (" ".join(MIT.split()[:9]), ""),
        ("to any person of this software", ""),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
        ("licensed under the GNU General Public License version 3", "gpl,gpl-3.0"),
        ("GNU Affero General Public License", "agpl,gpl"),
    ],
)
def test_notices(documents, text, labels):
    (got,) = query(documents([(1, text)])).collect()
    assert got.labels == labels
    assert 0 <= got.score <= 1 and (got.score > 0) == bool(labels)


def test_empty_table_and_plan(documents):
    found = query(documents([]))
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_templates_are_checked():
    with pytest.raises(ValueError):
        licenses.template_rows({"one": "x"}, {})
    with pytest.raises(ValueError):
        licenses.template_rows({"two words": "It's"}, {})
