"""File outputs and date-folder retention."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.config import ARCHIVE_RETENTION_DAYS
from ledgerspark.functions.dates import ntz_literal, parse_timestamp
from ledgerspark.sinks.tables import BATCH_TRANSFER

DAY_FORMAT = "yyyyMMdd"


def run_folder(base: str, *parts: str, as_of: dt.datetime | None = None) -> str:
    """A fresh folder per run: timestamp plus a random suffix, so two runs in
    the same second never share (and overwrite) a name."""
    stamp = (as_of or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    return os.path.join(base, *parts, f"{stamp}_{uuid.uuid4().hex[:8]}")


def extract_csv(df: DataFrame, out_dir: str, max_records: int = BATCH_TRANSFER) -> str:
    """K5: query result to CSV files of at most ``max_records`` rows each."""
    df.write.mode("errorifexists").option("header", True).option("maxRecordsPerFile", max_records).csv(out_dir)
    return out_dir


def write_csv(frames, base: str, name: str) -> list[str]:
    """K7: one frame -> ``{name}``; a list of n frames -> ``{name}_{i}``, i
    from 1. Anything else raises ValueError."""
    if isinstance(frames, DataFrame):
        targets = [(frames, os.path.join(base, name))]
    elif isinstance(frames, (list, tuple)) and frames and all(isinstance(f, DataFrame) for f in frames):
        targets = [(f, os.path.join(base, f"{name}_{i}")) for i, f in enumerate(frames, start=1)]
    else:
        raise ValueError("expected a DataFrame or a non-empty list of DataFrames")
    for df, path in targets:
        df.write.mode("overwrite").option("header", True).csv(path)
    return [p for _, p in targets]


def export_named(frames, names, base: str, fmt: str = "csv") -> dict[str, str]:
    """K8 (re-aimed from a multi-sheet workbook): one sub-folder per name; the
    two lists must have equal length."""
    frames, names = list(frames), list(names)
    if len(frames) != len(names):
        raise ValueError(f"{len(frames)} frames but {len(names)} sheet names")
    out = {}
    for df, name in zip(frames, names):
        path = os.path.join(base, name)
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
        out[name] = path
    return out


def day_partition(ts: Column) -> Column:
    """The ``yyyyMMdd`` folder value of a timestamp."""
    return F.date_format(ts, DAY_FORMAT)


def retained(part_value: Column, as_of: dt.date, days: int = ARCHIVE_RETENTION_DAYS) -> Column:
    """K11 rule on a folder value: keep when its date is not older than
    ``as_of - days`` (strict ``<`` deletes) or when it does not parse."""
    d = parse_timestamp(part_value, [DAY_FORMAT])
    cutoff = ntz_literal(as_of - dt.timedelta(days=days))
    return d.isNull() | (d >= cutoff)


def expire_partitions(df: DataFrame, part_col: str, as_of: dt.date, days: int = ARCHIVE_RETENTION_DAYS) -> DataFrame:
    """K11 as a DataFrame rule: the rows whose day folder is kept."""
    return df.filter(retained(F.col(part_col), as_of, days))


def delete_expired_folders(spark: SparkSession, base: str, as_of: dt.date,
                           days: int = ARCHIVE_RETENTION_DAYS, key: str = "") -> list[str]:
    """K11 on storage: delete ``base/<key=>yyyyMMdd`` folders older than the
    cutoff through the Hadoop file system of the path (local, HDFS or object
    store). Names that do not parse are kept. Returns the deleted folders."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    cutoff = as_of - dt.timedelta(days=days)
    deleted = []
    for st in fs.listStatus(path):  # one entry per day folder: bounded by the retention history
        if not st.isDirectory():
            continue
        name = st.getPath().getName()
        value = name[len(key) + 1:] if key and name.startswith(key + "=") else name
        try:
            day = dt.datetime.strptime(value, "%Y%m%d").date()
        except ValueError:
            continue
        if day < cutoff:
            fs.delete(st.getPath(), True)
            deleted.append(name)
    return deleted
