"""Registry of catalogue queries: id-prefixed name -> (Spark builder, oracle SQL).

Every builder takes (spark, sf_dir) and returns a lazy DataFrame over the
driver's tables (or data Spark derives from them). The oracle is DuckDB SQL
over the same tables; `None` marks a query checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their registrations run."""
    import importlib

    for name in MODULES:
        importlib.import_module(f"panelspark.plans.{name}")


MODULES = ("q_flow", "q_clean", "q_quality", "q_score", "q_panel", "q_series", "q_models", "q_segments", "q_store", "q_views")
