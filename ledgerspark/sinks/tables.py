"""Loading named frames into tables, with row-count audit.

A load is one write action per frame. Row counts come from an ``Observation``
on the written DataFrame, so the count is taken during the write and the
data is read once. Targets are JDBC tables, Parquet directories (the file
twin used where no database is at hand), or ``publish.PublishedTables``, whose loads of several tables are one commit.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Batch sizes of the reference's loaders.
BATCH_MYSQL = 10000
BATCH_POSTGRES = 5000
BATCH_GENERAL = 500000
BATCH_TRANSFER = 50000

AUDIT_SCHEMA = "script_name string, table_name string, data_count bigint, date date"


@dataclass
class JdbcTarget:
    """A database schema reached through Spark's JDBC writer."""
    options: dict
    schema: str | None = None
    batchsize: int = BATCH_MYSQL

    def table_name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def write(self, df: DataFrame, table: str, append: bool) -> None:
        w = (df.write.format("jdbc").options(**self.options).option("dbtable", self.table_name(table))
             .option("batchsize", self.batchsize))
        if append:
            w.mode("append").save()
        else:
            # TRUNCATE keeps the table definition; Spark creates the table when missing
            w.mode("overwrite").option("truncate", True).save()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options).option("dbtable", self.table_name(table)).load()


@dataclass
class ParquetTarget:
    """A directory of Parquet tables, one sub-folder per table."""
    base_path: str
    schema: str | None = None
    partition_by: tuple[str, ...] = field(default_factory=tuple)

    def path(self, table: str) -> str:
        return os.path.join(self.base_path, self.schema or "", table)

    def write(self, df: DataFrame, table: str, append: bool) -> None:
        w = df.write.mode("append" if append else "overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self.path(table))

    def write_batch(self, df: DataFrame, table: str, batch_id: int, by: tuple[str, ...] = ()) -> str:
        """One streaming micro-batch in a folder of its own, with a folder per value of ``by`` in it: writing it again replaces
        it. Returns the folder."""
        folder = os.path.join(self.path(table), f"batch_id={batch_id}")
        df.write.mode("overwrite").partitionBy(*by).parquet(folder)
        return folder

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def write_counted(df: DataFrame, target, table: str, append: bool) -> int:
    """Write one frame and return the number of rows written (counted in the
    same pass through ``Observation``)."""
    obs = Observation(f"rows_{table}")
    target.write(df.observe(obs, F.count(F.lit(1)).alias("n")), table, append)
    return int(obs.get["n"])


def upload(frames: dict[str, DataFrame], script_name: str, target, append: bool = False) -> dict[str, int]:
    """K1: each frame to table ``{script}_{name}``, replaced (truncate) or appended. Returns table -> rows written (every
    table, not only the last). A target that can ``publish`` shows all tables of the load at once or, after a failure, none;
    others are written one after another."""
    named = {f"{script_name}_{name}": df for name, df in frames.items()}
    if hasattr(target, "publish"):
        return target.publish(named, append)
    return {table: write_counted(df, target, table, append) for table, df in named.items()}


def _with_options(target, **options):
    """The target with those of ``options`` that its kind has."""
    return replace(target, **{k: v for k, v in options.items() if v is not None and k in target.__dataclass_fields__})


def load_replace(frames: dict[str, DataFrame], script_name: str, target) -> dict[str, int]:
    """K2: named frames, always replaced, in batches of ``BATCH_POSTGRES`` rows."""
    return upload(frames, script_name, _with_options(target, batchsize=BATCH_POSTGRES))


def load_into(frames: dict[str, DataFrame], script_name: str, target, schema: str, append: bool = False) -> dict[str, int]:
    """K3: named frames into ``schema`` of any target, replaced or appended, in batches of ``BATCH_GENERAL`` rows. A failure
    raises; on a target that can ``publish`` nothing of the load is seen then."""
    return upload(frames, script_name, _with_options(target, batchsize=BATCH_GENERAL, schema=schema), append)


def audit_rows(spark: SparkSession, script_name: str, counts: dict[str, int], on: dt.date) -> DataFrame:
    """One audit row per loaded table (a handful of rows, built on the driver)."""
    rows = [(script_name, t, int(n), on) for t, n in counts.items()]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def append_audit(spark: SparkSession, script_name: str, counts: dict[str, int], on: dt.date, target,
                 table: str = "data_count_log") -> DataFrame:
    """Append the audit rows to the audit table and return them."""
    rows = audit_rows(spark, script_name, counts, on)
    target.write(rows, table, append=True)
    return rows


def transfer(source: DataFrame, target, table: str, append: bool = False) -> int:
    """K4: move a source query's rows into a table (truncate first unless
    appending) in batches of ``BATCH_TRANSFER`` rows; rows stream through the executors, never the driver."""
    return write_counted(source, _with_options(target, batchsize=BATCH_TRANSFER), table, append)


def replace_tables(spark: SparkSession, frames: dict[str, DataFrame], location: str | None = None) -> DataFrame:
    """K9: replace catalog tables and return a (table_name, row_count) report.
    ``location`` stores them as external tables under that folder."""
    report = []
    for name, df in frames.items():
        obs = Observation(f"rows_{name}")
        w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format("parquet")
        if location:
            w = w.option("path", os.path.join(location, name))
        w.saveAsTable(name)
        report.append((name, int(obs.get["n"])))
    return spark.createDataFrame(report, "table_name string, row_count bigint")
