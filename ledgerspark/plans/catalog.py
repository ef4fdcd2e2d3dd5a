"""Registry of named queries over the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and, when the logic is
expressible in plain SQL, an oracle text for DuckDB over the same tables.
Every query reads whole tables (or data Spark derives from them); edge values
(NULLs, blanks, bad dates and numbers) are injected by deterministic rules on
the keys so that both engines derive the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}

# Fixed reference instant for every look-back filter (tests must repeat).
AS_OF = "2001-08-02 09:30:00"


def register(name: str, covers: tuple[str, ...] = (), oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        COVERS[name] = covers
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all():
    """Import every module that registers queries."""
    from ledgerspark.plans import (  # noqa: F401
        q_series, q_warehouse, q_etl, q_text, q_models, q_io, q_loads, q_scale,
    )
    return QUERIES, ORACLES
