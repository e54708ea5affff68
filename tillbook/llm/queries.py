"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from tillbook.llm import (
    decontaminate,
    filter_audit,
    fingerprints,
    hard_negatives,
    language,
    licences,
    mixture,
    ngram_join,
    secrets,
    token_store,
    topk,
    url_filter,
    warc,
)

QUERIES = {
    "op1_token_store": token_store.query,
    "op2_ngram_join": ngram_join.query,
    "op3_mixture": mixture.query,
    "op4_topk": topk.query,
    "op5_licences": licences.query,
    "op6_warc": warc.query,
    "op7_url_filter": url_filter.query,
    "op8_secrets": secrets.query,
    "op9_language": language.query,
    "op10_decontaminate": decontaminate.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_fingerprints": fingerprints.query,
    "op13_filter_audit": filter_audit.query,
}

# The others have no SQL form (or, op8, none for spans that do not overlap): see tests/llm.
ORACLES = {
    "op3_mixture": mixture.oracle(),
    "op4_topk": topk.ORACLE,
    "op5_licences": licences.oracle(),
    "op6_warc": warc.ORACLE,
    "op7_url_filter": url_filter.oracle(),
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_filter_audit": filter_audit.oracle(),
}
