"""All registered queries of this folder."""

from __future__ import annotations

from rillstone.llm import (
    collocations, conversation_trie, decontamination, html_extraction, jaccard_join, license_scans, packing, personal_data, quality_classifier, quality_rules,
    secret_scans, simhash, token_counts,
)

MODULES = (
    token_counts, quality_rules, personal_data, decontamination, packing, html_extraction, quality_classifier, simhash, secret_scans,
    license_scans, jaccard_join, conversation_trie, collocations,
)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
