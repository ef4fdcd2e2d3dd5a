"""Incremental-load control over run-log tables.

Log tables are ordinary DataFrames (Parquet or JDBC). Parquet has no UPDATE, so the upsert returns a new snapshot; ``record_runs``
publishes it together with the history rows as one commit of ``sinks.publish.PublishedTables``, so readers see the log before
or after the runs and never between.
``as_of`` is always passed in; nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.config import FULL_LOAD_LOOKBACK_DAYS
from ledgerspark.functions.dates import ntz_literal
from ledgerspark.operators.recon import latest_by
from ledgerspark.sinks.publish import StaleVersion

LOG_COLUMNS = ("script_name", "start_datetime", "end_datetime", "rundate", "status", "load_type")


def date_range(days: int, as_of: dt.datetime):
    """(midnight of as_of - days, as_of)."""
    start = dt.datetime.combine((as_of - dt.timedelta(days=days)).date(), dt.time())
    return start, as_of


def load_windows(logs: DataFrame, scripts: DataFrame, as_of: dt.datetime,
                 full_days: int = FULL_LOAD_LOOKBACK_DAYS) -> DataFrame:
    """Per script, [latest end_datetime, as_of, 'incremental'], or
    [midnight of as_of - full_days, as_of, 'full'] when it has no log row."""
    last = logs.groupBy("script_name").agg(F.max("end_datetime").alias("_last"))
    full_start, _ = date_range(full_days, as_of)
    return (scripts.select("script_name").distinct().join(last, "script_name", "left")
            .select("script_name",
                    F.coalesce(F.col("_last"), ntz_literal(full_start)).alias("date_from"),
                    ntz_literal(as_of).alias("date_to"),
                    F.when(F.col("_last").isNull(), "full").otherwise("incremental").alias("load_type")))


def upsert_run_log(logs: DataFrame, runs: DataFrame) -> DataFrame:
    """C3: 'full' runs are inserted; any other run updates *all* rows of its
    script (status, start, end, rundate, load_type); a run whose script has no
    row changes nothing. Several runs of one script in a batch: the latest
    (by end_datetime) wins."""
    runs = runs.select(*LOG_COLUMNS)
    inserts = runs.filter(F.col("load_type") == "full")
    updates = latest_by(runs.filter(F.col("load_type") != "full"), "script_name", ["end_datetime", "start_datetime"])
    upd = updates.select("script_name", F.lit(True).alias("_hit"),
                         *[F.col(c).alias(f"_new_{c}") for c in LOG_COLUMNS[1:]])
    updated = logs.select(*LOG_COLUMNS).join(upd, "script_name", "left").select(
        "script_name",
        *[F.when(F.col("_hit").isNotNull(), F.col(f"_new_{c}"))
          .otherwise(F.col(c)).alias(c) for c in LOG_COLUMNS[1:]])
    return updated.unionByName(inserts)


def history_rows(windows: DataFrame, start_col: str = "date_from", end_col: str = "date_to",
                 run_start=None) -> DataFrame:
    """C4: one history row per run, status 'Completed', rundate = window end."""
    start = F.col(start_col) if run_start is None else ntz_literal(run_start)
    return windows.select(
        "script_name", start.alias("start_datetime"), F.col(end_col).alias("end_datetime"),
        F.to_date(F.col(end_col)).alias("rundate"), F.lit("Completed").alias("status"),
        F.col("load_type"))


def record_runs(spark: SparkSession, store, runs: DataFrame, logs: str = "logs", history: str = "logs_history",
                attempts: int = 5) -> dict[str, int]:
    """C3 + C4 written: the upserted run log replaces the log table and the runs are appended to the history, in one commit. The
    upsert reads a version and is published only if that is still the newest; otherwise it is computed again from the newer
    one. Tables that do not exist yet start empty. Returns rows written per table."""
    for _ in range(attempts):
        now = store.manifest(spark)
        rows = runs.select(*LOG_COLUMNS)
        try:
            old = store.read_from(spark, logs, now)
        except KeyError:
            old = rows.limit(0)
        try:
            return store.publish({logs: upsert_run_log(old, rows), history: rows}, append=lambda table: table == history, expected=now.version)
        except StaleVersion:
            continue
    raise StaleVersion(f"{logs} changed {attempts} times while runs were recorded")


def append_history(history: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The history table with the new rows appended."""
    return history.select(*LOG_COLUMNS).unionByName(new_rows.select(*LOG_COLUMNS))
