"""The queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from . import bpe, classifier, codes, idstore, lexical, lines, mixing, neardup, packing, pages, passages, sharding, topk

QUERIES = {
    "op1_bpe": bpe.query,
    "op2_mixing": mixing.query,
    "op3_token_store": idstore.query,
    "op4_near_duplicates": neardup.query,
    "op5_pivot_topk": topk.query,
    "op6_line_rules": lines.query,
    "op7_best_fit": packing.query,
    "op8_classifier": classifier.query,
    "op9_passages": passages.query,
    "op10_sharding": sharding.query,
    "op11_lexical_search": lexical.query,
    "op12_vector_codes": codes.query,
    "op13_page_text": pages.query,
}

ORACLE = {"op5_pivot_topk": topk.ORACLE_SQL, "op10_sharding": sharding.ORACLE_SQL, "op11_lexical_search": lexical.ORACLE_SQL, "op12_vector_codes": codes.ORACLE_SQL}
