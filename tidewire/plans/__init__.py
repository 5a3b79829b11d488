"""Registered queries: the engine's operators over the driver's tables, with equivalent SQL."""

from tidewire.plans import audited, derived, landed, parsed, provided, refreshing, relational, routing, rules, scalars, structured  # noqa: F401
from tidewire.plans.registry import OPERATORS, ORACLES, QUERIES

#: The survey's operators that the queries of ``parsed``, ``relational`` and ``scalars`` run.
_RUN = {
    "consumer_fresh": "S13 J8", "feed_items_whole": "P1 P2", "future_filter": "F3", "feed_wildcard_join": "F4 K6", 
    "recruit_headline_whole": "F6", "cooldown_candidates": "F13", "asof_slot": "F18 K22 W6", "confirmed_receipts": "F19 K23", "news_upsert": "K7 A5 U1", "missing_expected": "K11 U5",
    "unexpected_or_duplicate": "K12", "set_equality_check": "K13 U6", "match_provider_school": "K14 C9", "longest_match_mentions": "K17 C2 O6 T15", "alias_unique_owner": "K18",
    "public_index": "J6 R29", "summarize_school": "A1 J9 X15", "scope_partition": "F1 F2", "previous_left_join": "K1", "provider_mapping_status": "K3", "provenance_counts": "K9 A17",
    "program_health": "A2 W9 R26", "source_health_groups": "A3 R26", "health_totals": "A4 A18 R27", "unique_by_id_last": "A6", "precision_merge": "A7", "conflicting_duplicates": "A8 A9",
    "declared_total_reconcile": "A10", "count_by": "A11", "affiliate_count": "A13", "affiliations_collect": "A14", "oldest_success": "A15", "status_fold": "A16", "football_health": "A18 C5 R27",
    "manifest_digest": "A20 T37 X3", "headline_day_dedup": "W1", "top_k_per_program": "W2 O1", "news_merge_topk": "W1 W2 O1 O9", "enrichment_rank": "W3", "metadata_budget": "W4 O8",
    "bounded_confirmations": "W5 O7", "section_carry_forward": "W7", "snapshot_violations": "X7", "violations": "X7", "clean_text": "T1", "clean_document": "T1", "cleaned_lengths": "T1",
    "safe_url": "T2", "public_value_scan": "T3", "stable_id": "T4", "canonical_url": "T6", "article_identity_url": "T7", "title_key": "T8", "slugify": "T10", "label_normalize": "T17",
    "url_host_route": "T23 T24 R11", "date_precision": "T27", "recruiting_cycle": "T31", "bounded_score": "T32", "age_hours": "T33", "clean_author": "T35", "html_title_text": "T36",
    "markdown_cell": "T44", "recruiting_section_status": "C4", "slot_plan": "C7 R35", "refresh_state": "C10", "navigation_kinds": "R13", "page_links": "F14 R20",
    "order_violations": "X7", "asof_last_view": "K22",
}
OPERATORS |= {name: tuple(ops.split()) for name, ops in _RUN.items()}

__all__ = ["OPERATORS", "ORACLES", "QUERIES"]
