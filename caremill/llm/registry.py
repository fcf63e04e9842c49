"""Queries of the operators in this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from caremill.llm import bpe, chat_format, decontamination, exact_dedup, html_extract, language_id, license_scan, lm_score, near_dedup, periodic_runs, substring_dedup, suffix_dedup, whitening

MODULES = [decontamination, language_id, license_scan, exact_dedup, lm_score, bpe, substring_dedup, html_extract, near_dedup, chat_format, periodic_runs, whitening, suffix_dedup]


def queries() -> dict:
    return {name: getattr(m, name) for m in MODULES for name in vars(m) if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict:
    return {name: m.ORACLE_SQL for m in MODULES if getattr(m, "ORACLE_SQL", None) for name in vars(m) if name.startswith("op") and name[2].isdigit()}
