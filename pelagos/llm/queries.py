"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

MODULES = tuple("op1_packing op2_fingerprint op3_extraction op4_media op5_jaccard_join op6_language op7_sharding op8_mixing op9_url_filter op10_suffix_array".split())


def _modules():
    return [import_module(f"pelagos.llm.{m}") for m in MODULES]


def queries() -> dict:
    return {m.NAME: m.query for m in _modules()}


def oracle_sql() -> dict:
    return {m.NAME: m.ORACLE_SQL for m in _modules() if m.ORACLE_SQL}
