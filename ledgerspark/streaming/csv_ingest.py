"""K6: load a landing folder of CSV files into a table and archive what was loaded.

Structured Streaming over the folder with ``trigger(availableNow=True)``: each run loads only files not seen before (tracked in
the checkpoint), writes them through ``foreachBatch`` and moves processed files to the archive folder
(``cleanSource=archive``). ``foreachBatch`` may run a batch again after a failure: a target with ``write_batch`` keeps each batch
under its id and replaces it then, so rows load exactly once (its table has the columns ``batch_id`` and ``source_file``);
other targets (JDBC) append at least once.

Every batch is logged per file: (file, rows, batch_id). Where the target keeps batches, the file is a folder of the batch, so its
rows are counted from what was written, out of the footers, and the log is a batch of its own table that a replay replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sinks.tables import write_counted
from ledgerspark.sources.files import file_name


FILE = "source_file"
LOG_SUFFIX = "_file_log"


def load_csv_dir(spark: SparkSession, src_dir: str, schema, target, table: str) -> int:
    """Batch K6: every CSV of the folder replaces the table's rows."""
    df = spark.read.option("header", True).schema(schema).csv(src_dir)
    return write_counted(df, target, table, append=False)


def file_counts(rows: DataFrame) -> DataFrame:
    """(file, rows) of a frame with the column ``source_file``."""
    return rows.groupBy(F.col(FILE).cast("string").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def load_batch(batch: DataFrame, batch_id: int, target, table: str) -> int:
    """Load one micro-batch with its file log (where it has the column ``source_file``); returns its rows."""
    by_file = FILE in batch.columns
    if not hasattr(target, "write_batch"):
        if by_file:
            target.write(file_counts(batch).withColumn("batch_id", F.lit(batch_id)), table + LOG_SUFFIX, append=True)
        return write_counted(batch.drop(FILE), target, table, append=True)
    seen = Observation(f"rows_{table}_{batch_id}")
    folder = target.write_batch(batch.observe(seen, F.count(F.lit(1)).alias("n")), table, batch_id, (FILE,) if by_file else ())
    if by_file and seen.get["n"]:
        written = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        target.write_batch(file_counts(written).coalesce(1), table + LOG_SUFFIX, batch_id)
    return int(seen.get["n"])


def ingest_new_csv(spark: SparkSession, src_dir: str, schema, target, table: str, archive_dir: str,
                   checkpoint_dir: str, max_files_per_trigger: int | None = None) -> list[dict]:
    """Incremental K6: append the new files' rows, archive the files, log each file in ``{table}_file_log``, and return one entry
    per micro-batch (batch id and rows loaded)."""
    log: list[dict] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        log.append({"batch_id": batch_id, "rows": load_batch(batch, batch_id, target, table)})

    reader = (spark.readStream.schema(schema).option("header", True)
              .option("cleanSource", "archive").option("sourceArchiveDir", archive_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(src_dir).select("*", file_name().alias(FILE))
    query = (rows.writeStream.foreachBatch(run)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    return log


def file_log(spark: SparkSession, target, table: str) -> DataFrame:
    """(file, rows, batch_id) of everything loaded into ``table`` so far."""
    log = target.read(spark, table + LOG_SUFFIX)
    return log.select("file", "rows", F.col("batch_id").cast("long").alias("batch_id"))
