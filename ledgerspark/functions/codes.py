"""Lookup expressions over fixed code lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: warehouse code -> site name.
WAREHOUSE_NAMES = {"0006": "Rawa", "0018": "Gyal", "0021": "Romania"}
# Site id -> source tag used by the warehouse extracts.
SITE_SOURCES = {21: "Romania", 18: "Gyal", 6: "Rawa"}


def warehouse_name(c) -> Column:
    """Code to name CASE; unknown codes give NULL (first match wins)."""
    code = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in WAREHOUSE_NAMES.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr
