"""Operators for training-data pipelines; nothing else of the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

MODULES = ("prefix_tokens", "toxicity", "quality_gam", "pieces", "html_density", "secrets", "unit_dedup", "decontaminate", "vafile", "ngram_join", "log_bilinear", "dialogue_repair", "source_audit")


def collected(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found |= getattr(import_module(f"textmill.llm.{module}"), name)
    return found


def queries() -> dict:
    return collected("QUERIES")


def oracle_sql() -> dict:
    return collected("ORACLE_SQL")
