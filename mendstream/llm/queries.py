"""One query per operator over its whole table, with the SQL that states the same result where SQL can."""
from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame

NAMES = {
    "op1_bpe": ("bpe", "op1"),
    "op2_fingerprints": ("fingerprint", "op2"),
    "op3_top_k": ("topk", "op3"),
    "op4_toxicity": ("toxicity", "op4"),
    "op5_perspectives": ("chat", "op5"),
    "op6_mix": ("mixing", "op6"),
    "op7_suffix_dedup": ("suffix", "op7"),
    "op8_quality": ("quality", "op8"),
    "op9_ngram_join": ("ngramjoin", "op9"),
    "op10_url_filter": ("urls", "op10"),
    "op11_simhash": ("simhash", "op11"),
    "op12_alignment": ("align", "op12"),
    "op13_divergence": ("skyband", "op13"),
}


def _call(module: str, function: str) -> Callable:
    def run(spark, sf_dir: str) -> DataFrame:
        return getattr(import_module(f"mendstream.llm.{module}"), function)(spark, sf_dir)

    return run


def queries() -> dict[str, Callable]:
    return {name: _call(*where) for name, where in NAMES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the modules that state it in ``SQL``."""
    found = {}
    for name, (module, function) in NAMES.items():
        sql = getattr(import_module(f"mendstream.llm.{module}"), "SQL", None)
        if sql and function.startswith("op"):
            found[name] = sql
    return found
