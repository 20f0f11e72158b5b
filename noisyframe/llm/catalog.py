"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "token_counts", "near_dedup", "chat_format", "substring_dedup", "decontaminate",
    "url_filter", "quality_rules", "language_id", "packing", "html_extract", "quality_classifier", "token_alignment", "divergence",
]


def _modules():
    return [import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict:
    return {m.QUERY: m.query for m in _modules()}


def oracle_sql() -> dict:
    return {m.QUERY: m.ORACLE_SQL for m in _modules() if m.ORACLE_SQL}
