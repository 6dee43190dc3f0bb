"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build a documents table of ``(doc_id, text[, lang, source])`` rows."""

    def make(rows, extra=()):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *[e[1] for e in extra]))
        schema = SCHEMA + "".join(f", `{name}` string" for name, _ in extra)
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def awkward():
    """One row per awkward case, ids not unique."""
    long_text = "lorem ipsum dolor " * 20_000
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "   \n\t ", "en", "a"),
        (4, long_text, "la", "b"),
        (4, long_text, "la", "b"),
        (5, "Ünïcode İ K é́ \U0001f600 <|endoftext|> \x1c x", "en", None),
        (None, "no id", "en", "a"),
        (None, "no id", "en", "a"),
        (6, "The MIT License", "en", "a"),
        (7, "the mit license!", "en", "c"),
        (8, "x" * 5000, None, "c"),
        (-9, "The MIT License", "en", "a"),
    ]
