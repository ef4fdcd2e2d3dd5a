"""Q0-Q3: SQL over named DataFrames, scalar counts, record counts.

Frames are registered as session temp views under their keyword names and the
text runs through Catalyst; nothing is copied into another engine.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

_VIEWS = threading.Lock()


def run_sql(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run Spark SQL with each keyword frame visible under its name (Q0).

    ``args`` binds named parameters (``:name``) instead of pasting text, the
    Spark form of the reference's positional ``%s`` tuple (S2).
    """
    with _VIEWS:  # views live only while the text is analysed; what they shadowed comes back
        shadowed = {n: spark.table(n) for n in frames if spark.catalog.tableExists(n) and spark.catalog.getTable(n).isTemporary}
        try:
            for name, df in frames.items():
                df.createOrReplaceTempView(name)
            return spark.sql(sql, args=args) if args else spark.sql(sql)
        finally:
            for name in frames:
                spark.catalog.dropTempView(name)
            for name, df in shadowed.items():
                df.createOrReplaceTempView(name)


def df_count(spark: SparkSession, sql: str, **frames: DataFrame) -> int:
    """Q1: the ``count`` column of the first row of a SQL result."""
    row = run_sql(spark, sql, **frames).first()
    return None if row is None else row["count"]


def count_records(df: DataFrame) -> int:
    """Q2: number of rows."""
    return df.count()
