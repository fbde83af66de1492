"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from assayframe.llm import (
    budget_mix,
    chosen_path,
    external_shuffle,
    fertility,
    lz_fingerprint,
    mixture_packing,
    ordinal_quality,
    phrase_mining,
    piece_codec,
    pii_votes,
    prefix_counts,
    prefix_trie,
    url_filter,
)

QUERIES = {
    "op1_lz_fingerprint": lz_fingerprint.query,
    "op2_pii_votes": pii_votes.query,
    "op3_prefix_counts": prefix_counts.query,
    "op4_budget_mix": budget_mix.query,
    "op5_external_shuffle": external_shuffle.query,
    "op6_piece_codec": piece_codec.query,
    "op7_fertility": fertility.query,
    "op8_ordinal_quality": ordinal_quality.query,
    "op9_url_filter": url_filter.query,
    "op10_chosen_path": chosen_path.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_phrase_mining": phrase_mining.query,
    "op13_mixture_packing": mixture_packing.query,
}

ORACLES: dict[str, str] = {
    "op9_url_filter": url_filter.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_phrase_mining": phrase_mining.SQL,
}
