"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from lakestrata.llm import (
    codes, exact, hmm, hosts, jaccard, language, merkle, mixing, passages, pieces, secrets, substrings, urls)

QUERIES = {
    "op1_source_mix": mixing.query,
    "op2_hidden_markov": hmm.query,
    "op3_host_rules": hosts.query,
    "op4_substring_dedup": substrings.query,
    "op5_language_id": language.query,
    "op6_jaccard_join": jaccard.query,
    "op7_url_filter": urls.query,
    "op8_sentencepiece": pieces.query,
    "op9_exact_dedup": exact.query,
    "op10_passage_dedup": passages.query,
    "op11_merkle_manifest": merkle.query,
    "op12_secret_scan": secrets.query,
    "op13_vector_codes": codes.query,
}
ORACLES = {
    "op1_source_mix": mixing.ORACLE,
    "op3_host_rules": hosts.ORACLE,
    "op6_jaccard_join": jaccard.ORACLE,
    "op9_exact_dedup": exact.ORACLE,
    "op10_passage_dedup": passages.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_secret_scan": secrets.ORACLE,
    "op13_vector_codes": codes.ORACLE,
}
