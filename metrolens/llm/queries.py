"""The ``opN_<name>`` queries of this subpackage and the SQL of those that SQL can express."""

from metrolens.llm import (
    collocations,
    exact_dedup,
    html_text,
    language,
    licenses,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    spelling,
    token_files,
    topk,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_licenses": licenses.op2_licenses,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_html": html_text.op4_html,
    "op5_sharding": sharding.op5_sharding,
    "op6_packing": packing.op6_packing,
    "op7_language": language.op7_language,
    "op8_quality": quality.op8_quality,
    "op9_topk": topk.op9_topk,
    "op10_mixing": mixing.op10_mixing,
    "op11_spelling": spelling.op11_spelling,
    "op12_collocations": collocations.op12_collocations,
    "op13_token_files": token_files.op13_token_files,
}

ORACLE_SQL = {
    "op2_licenses": licenses.oracle_sql(),
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op5_sharding": sharding.oracle_sql(),
    "op9_topk": topk.ORACLE_SQL,
    "op10_mixing": mixing.oracle_sql(),
    "op11_spelling": spelling.oracle_sql(),
    "op12_collocations": collocations.ORACLE_SQL,
}
