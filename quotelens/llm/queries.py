"""Registered queries of the operators: each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotelens.llm import (
    brown_lm, decontamination, language_id, licence_scan, minhash_dedup, packing, phrase_mining, projection_dedup, rendezvous,
    secret_scan, token_counts, tree_packing, whitening,
)
from quotelens.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": licence_scan.op1_licence_scan,
    "op2_brown_lm": brown_lm.op2_brown_lm,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_language_id": language_id.op4_language_id,
    "op5_minhash_near_dedup": minhash_dedup.op5_minhash_near_dedup,
    "op6_rendezvous_sharding": rendezvous.op6_rendezvous_sharding,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_benchmark_decontamination": decontamination.op8_benchmark_decontamination,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_projection_dedup": projection_dedup.op10_projection_dedup,
    "op11_phrase_mining": phrase_mining.op11_phrase_mining,
    "op12_whitening": whitening.op12_whitening,
    "op13_tree_packing": tree_packing.op13_tree_packing,
}
