"""The registry and every query with SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, duck  # noqa: E402

import __spark_entry__  # noqa: E402
from metrolens.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    problems, _, _ = compare(spark, duck(SF), key, SF, QUERIES[key], ORACLE_SQL[key])
    assert not problems, problems


def test_registered():
    found = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize(
    "key,columns",
    [
        ("op1_simhash", "doc_id fingerprint component_id"),
        ("op2_licenses", "doc_id n_words n_base first_word last_word base_labels labels score"),
        ("op3_exact_dedup", "doc_id keep_id group_size kept text_sha256"),
        ("op4_html", "page_id url text n_chars"),
        ("op6_packing", "doc_id start length ids_crc32 doc_tokens sequence_id offset"),
        ("op7_language", "doc_id held_out lang_pred score"),
        ("op8_quality", "doc_id held_out score predicted"),
        ("op9_topk", "query_id rank vec_id score"),
        ("op10_mixing", "doc_id size source_size target taken"),
        ("op11_spelling", "word form root n n_near form_n"),
        ("op12_collocations", "lang rank phrase a l r n score"),
        ("op13_token_files", "doc_id start n_tokens ids_crc32"),
    ],
)
def test_columns(spark, key, columns):
    found = QUERIES[key](spark, SF)
    assert found.columns[: len(columns.split())] == columns.split()
    longs = {"n_words", "n_base", "first_word", "last_word", "group_size", "n_chars", "start", "length", "ids_crc32"}
    longs |= {"doc_tokens", "sequence_id", "offset", "query_id", "vec_id", "size", "source_size", "taken"}
    longs |= {"score"} if key in ("op9_topk", "op12_collocations") else set()
    longs |= {"n", "n_near", "form_n", "n_tokens", "a", "l", "r"} | ({"rank"} if key == "op12_collocations" else set())
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in longs & set(kinds)} == {c: "bigint" for c in longs & set(kinds)}
