"""The operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from . import (
    bytebpe,
    decontaminate,
    divergence,
    filteraudit,
    fingerprint,
    langid,
    licenses,
    mixture,
    neardup,
    sharding,
    substrings,
    tokencount,
    urlfilter,
)

LLM_QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_url_rules": urlfilter.op2_url_rules,
    "op3_near_dedup": neardup.op3_near_dedup,
    "op4_fingerprints": fingerprint.op4_fingerprints,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_suffix_dedup": substrings.op6_suffix_dedup,
    "op7_token_counts": tokencount.op7_token_counts,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_source_mix": mixture.op9_source_mix,
    "op10_rendezvous_shards": sharding.op10_rendezvous_shards,
    "op11_filter_audit": filteraudit.op11_filter_audit,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_byte_bpe": bytebpe.op13_byte_bpe,
}

LLM_ORACLE = {
    "op2_url_rules": urlfilter.OP2_SQL,
    "op3_near_dedup": neardup.OP3_SQL,
    "op6_suffix_dedup": substrings.OP6_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op10_rendezvous_shards": sharding.OP10_SQL,
    "op11_filter_audit": filteraudit.OP11_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
}
