"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = {
    "op1_byte_bpe": "op1_bpe",
    "op2_decontamination": "op2_decontaminate",
    "op3_html_extraction": "op3_html",
    "op4_quality_rules": "op4_quality",
    "op5_chat_format": "op5_chat",
    "op6_ngram_join": "op6_join",
    "op7_license_scan": "op7_licenses",
    "op8_substring_dedup": "op8_substrings",
    "op9_quality_classifier": "op9_classifier",
    "op10_language_id": "op10_language",
    "op11_vector_codes": "op11_codes",
    "op12_secret_scan": "op12_secrets",
    "op13_token_alignment": "op13_align",
}


#: Operators with SQL.
SQL = ("op7_license_scan",)


def _query(module: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query of a module, which is imported when the query is asked for: a library that one operator lacks keeps no other from running."""
    return lambda spark, sf_dir: import_module(f"turnwright.llm.{module}").query(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(module) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: import_module(f"turnwright.llm.{MODULES[name]}").ORACLE_SQL for name in SQL}
