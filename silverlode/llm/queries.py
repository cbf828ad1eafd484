"""Registered queries of this subpackage: name -> (query, SQL or None)."""

from silverlode.llm import jaccard_join, language_id, license_scan, packing, piece_sampling, quality_rules, secret_scan, spelling_variants, suffix_dedup, token_counts, topk_search, tree_weighting, turn_repair

_MODULES = (tree_weighting, quality_rules, packing, license_scan, suffix_dedup, topk_search, language_id, piece_sampling, secret_scan, jaccard_join, token_counts, spelling_variants, turn_repair)
QUERIES = {name: pair for module in _MODULES for name, pair in module.QUERIES.items()}
