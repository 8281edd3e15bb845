"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from monthledger.llm import bpe, caps, chat, html, jaccard, licenses, merkle, mixing, quality, resample, secrets, trie, warc

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_warc_revisits": warc.op2,
    "op3_cap_filters": caps.op3,
    "op4_secret_ledger": secrets.op4,
    "op5_wrapper_text": html.op5,
    "op6_byte_bpe": bpe.op6,
    "op7_ordinal_quality": quality.op7,
    "op8_ngram_jaccard": jaccard.op8,
    "op9_license_rules": licenses.op9,
    "op10_merkle_fingerprints": merkle.op10,
    "op11_prefix_trie": trie.op11,
    "op12_target_resample": resample.op12,
    "op13_prefix_targets": chat.op13,
}
SQL = {
    "op1_mix_sources": mixing.SQL,
    "op2_warc_revisits": warc.SQL,
    "op3_cap_filters": caps.SQL,
    "op11_prefix_trie": trie.SQL,
    "op12_target_resample": resample.SQL,
    "op13_prefix_targets": chat.SQL,
}
