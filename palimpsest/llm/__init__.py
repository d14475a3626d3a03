"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query -> its module here.
MODULES = {
    "op1_quality_divergence": "quality",
    "op2_winnow_decontaminate": "decontaminate",
    "op3_trigram_secrets": "secrets",
    "op4_chosen_path_dedup": "near_dedup",
    "op5_mixture_language": "language",
    "op6_retrieval_packing": "packing",
    "op7_seed_extend_dedup": "substring_dedup",
    "op8_stratified_interleave": "sharding",
    "op9_transducer_token_counts": "token_counts",
    "op10_bwt_merge_dedup": "suffix_dedup",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"{__name__}.{m}"), name) for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express."""
    found = {name: getattr(import_module(f"{__name__}.{m}"), "ORACLE", None) for name, m in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
