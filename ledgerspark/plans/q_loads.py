"""Loads that are seen whole, files that lose no line, and files archived: K1-K3, K6, K11, S4, M7, C3-C5.

Every query derives its files and tables from the given ones, runs the load under the shared checkpoint folder, and
returns what lies there afterwards.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.numeric import text_to_double
from ledgerspark.models import runner
from ledgerspark.operators import control, recon, validate
from ledgerspark.plans.catalog import ORACLES, register
from ledgerspark.plans.q_etl import _LOGS_SQL, _new_runs, run_logs
from ledgerspark.plans.q_series import _BRAND_SUMS, CFG_BRAND, brand_input, wide_sales_sheet
from ledgerspark.session import scratch_table_path, table
from ledgerspark.sinks import archive, files as fsink, tables as tsink
from ledgerspark.sinks.publish import PublishedTables, StaleVersion
from ledgerspark.sources import files as fsrc
from ledgerspark.streaming import csv_ingest

ON = dt.date(2024, 2, 1)


def _run_dir(spark, name: str) -> str:
    return scratch_table_path(spark, f"{name}/{uuid.uuid4().hex[:12]}")


# --- K11: archive -------------------------------------------------------------------------------

_SCRIPTS = {"clicks": "click", "clickstream_2": "view", "orders": "purchase"}


def _script_of(col: str) -> str:
    return (f"CASE WHEN {col} = 'click' THEN 'clicks' WHEN {col} = 'view' THEN 'clickstream_2' WHEN {col} = 'purchase' THEN 'orders' ELSE 'rest' END")


@register("k11_archive_ready_files", ("K11", "K5"), oracle=f"""
SELECT CASE WHEN s IN ('orders', 'rest') THEN 'Finale' ELSE 'archive' END AS place, CASE WHEN s NOT IN ('orders', 'rest') THEN '20240201' END AS day, s AS script, count(*) AS n_rows,
       CAST(sum(event_id) AS BIGINT) AS id_sum
FROM (SELECT event_id, {_script_of('event_type')} AS s FROM events) GROUP BY s
""")
def k11_archive_ready_files(spark, sf):
    """Events extracted into ready files of four scripts; a run archives those that start with ``click``, and a second run and a
    run that finds a copied file again change nothing. Returns the rows that lie in each place."""
    base = _run_dir(spark, "k11a")
    folders = archive.run_folders(spark, base, "click", ON)
    ev = table(spark, sf, "events").select("event_id", F.expr(_script_of("event_type")).alias("script"))
    for script in (*_SCRIPTS, "rest"):
        out = fsink.extract_csv(ev.filter(F.col("script") == script), os.path.join(base, "extract", script))
        archive.publish_files(spark, out, folders["ready"], script)
    moved, _ = archive.archive_run(spark, base, "click", ON)
    again, _ = archive.archive_run(spark, base, "click", ON)
    if moved.isEmpty() or not again.isEmpty():
        raise AssertionError("ready files are moved once")
    rows = (spark.read.schema("event_id bigint, script string").option("header", True).option("recursiveFileLookup", True)
            .csv(os.path.join(base, "click")).select("*", F.col("_metadata.file_path").alias("path")))
    place = F.regexp_extract("path", "/(Finale|archive)/", 1)
    day = F.nullif(F.regexp_extract("path", "/archive/([0-9]{8})/", 1), F.lit(""))
    return rows.groupBy(place.alias("place"), day.alias("day"), "script").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))


# --- K1, K2, K3, M7: several tables as one -----------------------------------------------------

@register("k1_publish_is_all_or_nothing", ("K1", "K10"), oracle="""
SELECT 'sales_orders' AS table_name, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders
UNION ALL SELECT 'sales_lines', count(*), round(sum(l_quantity), 2) FROM lineitem
""")
def k1_publish_is_all_or_nothing(spark, sf):
    """Two tables loaded in one commit; then a load that replaces both and fails in the second. Both old tables are what readers
    see after it."""
    store = PublishedTables(_run_dir(spark, "k1"))
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    tsink.upload({"orders": orders, "lines": lines}, "sales", store)
    broken = lines.withColumn("l_quantity", F.when(F.col("l_linenumber") > 0, F.raise_error(F.lit("lost source"))).otherwise(F.col("l_quantity")))
    try:
        tsink.upload({"orders": orders.filter("o_orderstatus = 'F'"), "lines": broken}, "sales", store)
    except Exception as e:  # noqa: BLE001 -- any failure of the source, however Spark wraps it
        if "lost source" not in str(e):
            raise
    else:
        raise AssertionError("the second load must fail")
    now = store.manifest(spark)
    parts = [store.read_from(spark, t, now).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(c), 2).alias("total"))
             for t, c in (("sales_orders", "o_totalprice"), ("sales_lines", "l_quantity"))]
    return recon.union_all(*parts)


@register("k2_replace_load", ("K2",), oracle="SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def k2_replace_load(spark, sf):
    """Named frames loaded by the loader that always replaces: the second load's rows are all there are."""
    store = PublishedTables(_run_dir(spark, "k2"))
    orders = table(spark, sf, "orders")
    tsink.load_replace({"orders": orders, "part": table(spark, sf, "part")}, "pg", store)
    tsink.load_replace({"orders": orders.filter("o_orderstatus <> 'F'")}, "pg", store)
    return store.read(spark, "pg_orders")


@register("k3_schema_load", ("K3", "K10"), oracle="""
SELECT 'stage.gen_orders' AS table_name, 2 * count(*) AS row_count, 2 AS folders FROM orders
UNION ALL SELECT 'stage.gen_part', count(*), 1 FROM part
""")
def k3_schema_load(spark, sf):
    """Named frames loaded into a schema, one of them appended to in a second load."""
    store = PublishedTables(_run_dir(spark, "k3"))
    orders = table(spark, sf, "orders")
    tsink.load_into({"orders": orders, "part": table(spark, sf, "part")}, "gen", store, "stage")
    tsink.load_into({"orders": orders}, "gen", store, "stage", append=True)
    return store.report(spark)


@register("m7_published_tables", ("M7", "K1", "R4", "T11"), oracle=f"""
WITH {_BRAND_SUMS}, members AS (SELECT DISTINCT p_brand, n FROM f WHERE n >= 24),
raw AS (SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey),
fit AS (SELECT sum(CASE WHEN n >= 36 THEN 1 ELSE 0 END) AS hw, sum(CASE WHEN n - 12 >= 11 THEN 1 ELSE 0 END) AS ar, sum(n) AS periods,
               sum(CASE WHEN n >= 36 THEN n - 12 ELSE 0 END) + sum(CASE WHEN n - 12 >= 11 THEN n - 12 ELSE 0 END) AS train, count(*) AS series FROM members)
SELECT 'brand_source' AS table_name, n AS row_count, 1 AS folders FROM raw
UNION ALL SELECT 'brand_rejected_data', 0, 1
UNION ALL SELECT 'brand_forecast', CAST(12 * (hw + ar) AS BIGINT), 1 FROM fit
UNION ALL SELECT 'brand_train', CAST(train AS BIGINT), 1 FROM fit
UNION ALL SELECT 'brand_test', CAST(12 * (hw + ar) AS BIGINT), 1 FROM fit
UNION ALL SELECT 'brand_errors', CAST(2 * series - hw - ar AS BIGINT), 1 FROM fit
""")
def m7_published_tables(spark, sf):
    """A forecast run's tables in one commit: rows per table of the version that readers see (scores aside)."""
    store = PublishedTables(_run_dir(spark, "m7"))
    raw = brand_input(spark, sf).withColumn("l_quantity", F.col("l_quantity").cast("string"))
    runner.forecast_and_load(raw, CFG_BRAND, "brand", store, ["Holt-Winters", "ARIMA"])
    if store.versions(spark) != [1]:
        raise AssertionError("one run is one commit")
    return store.report(spark).filter("table_name <> 'brand_forecast_error'")


# --- S5: the wide sheet from a file ---------------------------------------------------------------

@register("s5_wide_sheet_from_file", ("S5", "R1"), oracle=ORACLES["r1_wide_to_long"])
def s5_wide_sheet_from_file(spark, sf):
    """The wide monthly sheet exported as a file, read back as text cells and reshaped."""
    [path] = fsink.write_csv(wide_sales_sheet(spark, sf), _run_dir(spark, "s5"), "sheet.csv")
    long = validate.reshape_wide(fsrc.read_wide_sheet(spark, path), "Material", 9, "Date", "Sales")
    return long.withColumn("Sales", text_to_double("Sales"))


# --- S4: no line lost -----------------------------------------------------------------------------

_KIND = "(l_orderkey * 7 + l_linenumber) % 40"
_FIELDS = "l_orderkey, l_linenumber, CASE WHEN {kind} = 3 THEN 'x' || CAST(CAST(l_quantity AS INT) AS {text}) ELSE CAST(CAST(l_quantity AS INT) AS {text}) END"


def _line_sql(text: str) -> str:
    """A CSV line per lineitem row; some too short (0), too long (1), with an open quote (2, 5) or a bad number (3, 6)."""
    def cat(*parts):
        return " || ".join(f"CAST({p} AS {text})" for p in parts)
    head = cat("l_orderkey", "','", "l_linenumber", "','")
    tail = "',\"' || l_returnflag || ', ' || l_linestatus || '\"'"
    qty = f"CAST(CAST(l_quantity AS INT) AS {text})"
    return (f"CASE {_KIND} WHEN 0 THEN {head} || {qty} WHEN 1 THEN {head} || {qty} || {tail} || ',more' WHEN 2 THEN {head} || {qty} || ',\"' || l_returnflag"
            f" WHEN 3 THEN {head} || 'x' || {qty} || {tail} WHEN 5 THEN {head} || '\"' || {qty} || ',' || l_returnflag WHEN 6 THEN 'k' || {head} || {qty} || {tail}"
            f" ELSE {head} || {qty} || {tail} END")


LINE_COLUMNS = "l_orderkey bigint, l_linenumber int, l_quantity int, status string"
_BAD = "(0, 1, 2, 3, 5, 6)"


def _checked(spark, sf, name: str):
    base = _run_dir(spark, name)
    table(spark, sf, "lineitem").select(F.expr(_line_sql("STRING")).alias("value")).write.text(os.path.join(base, "lines"))
    return fsrc.read_checked(spark, os.path.join(base, "lines"), LINE_COLUMNS, header=False, written=os.path.join(base, "checked"))


@register("s4_checked_rows", ("S4",), oracle=f"""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS l_quantity, l_returnflag || ', ' || l_linestatus AS status FROM lineitem WHERE {_KIND} NOT IN {_BAD}
""")
def s4_checked_rows(spark, sf):
    """The lines of a file that are rows."""
    return _checked(spark, sf, "s4c")[0]


@register("s4_rejected_lines", ("S4", "R4"), oracle=f"""
SELECT {_line_sql('VARCHAR')} AS line, CASE WHEN {_KIND} = 0 THEN 'Missing fields; ' WHEN {_KIND} = 1 THEN 'Extra fields; ' WHEN {_KIND} IN (2, 5) THEN 'Unclosed quote; '
       ELSE 'Invalid value; ' END AS "Error_Flag" FROM lineitem WHERE {_KIND} IN {_BAD}
""")
def s4_rejected_lines(spark, sf):
    """The lines that are no rows, with the reason."""
    return _checked(spark, sf, "s4r")[1].select("line", validate.ERROR_FLAG)


_CFG_FILE = SeriesConfig("status", "day", "l_quantity")


@register("s4_file_to_rejected_table", ("S4", "R4", "K1", "D9"), oracle=f"""
WITH k AS (SELECT *, {_KIND} AS k FROM lineitem),
r AS (SELECT CASE WHEN k = 0 THEN 'Missing fields; ' WHEN k = 1 THEN 'Extra fields; ' WHEN k IN (2, 5) THEN 'Unclosed quote; ' WHEN k IN (3, 6) THEN 'Invalid value; '
                  WHEN k = 7 THEN 'Invalid day; ' ELSE '' END AS reason FROM k)
SELECT reason, count(*) AS n FROM r GROUP BY reason
""")
def s4_file_to_rejected_table(spark, sf):
    """A file into two published tables, the clean rows and all rejected ones: lines that are no rows and rows that R4 rejects (a bad
    date). Returns the rows of both by reason; together they are the file's lines."""
    rows, lines = _checked(spark, sf, "s4t")
    bad_day = f"CASE WHEN {_KIND} = 7 THEN 'soon' ELSE '2024-02-01' END"
    clean, errors, _ = validate.validate_split(rows.withColumn("day", F.expr(bad_day)), _CFG_FILE)
    store = PublishedTables(_run_dir(spark, "s4p"))
    tsink.upload({"source": clean, "rejected_data": validate.rejected_with_lines(errors, lines)}, "file", store)
    now = store.manifest(spark)
    rejected = store.read_from(spark, "file_rejected_data", now).select(F.col(validate.ERROR_FLAG).alias("reason"))
    good = store.read_from(spark, "file_source", now).select(F.lit("").alias("reason"))
    return rejected.unionByName(good).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- K6: a log row per file -----------------------------------------------------------------------

@register("k6_file_log", ("K6", "K10"), oracle="""
SELECT 'orders_' || o_orderpriority[1] AS file, count(*) AS rows FROM orders GROUP BY 1
""")
def k6_file_log(spark, sf):
    """Orders in one file group per priority, ingested two files a batch; the last batch is replayed, and the log still has each
    file's rows once. Returns the rows by file group."""
    base = _run_dir(spark, "k6l")
    orders = table(spark, sf, "orders")
    schema = orders.schema
    landing = os.path.join(base, "landing")
    for p in "12345":
        out = fsink.extract_csv(orders.filter(F.substring("o_orderpriority", 1, 1) == p), os.path.join(base, "extract", p))
        archive.publish_files(spark, out, landing, f"orders_{p}")
    target = tsink.ParquetTarget(os.path.join(base, "stage"))
    runs = csv_ingest.ingest_new_csv(spark, landing, schema, target, "orders", os.path.join(base, "archive"), os.path.join(base, "_checkpoint"), max_files_per_trigger=2)
    last = runs[-1]["batch_id"]
    replayed = target.read(spark, "orders").filter(F.col("batch_id") == last).drop("batch_id")
    kept = os.path.join(base, "replay")
    replayed.write.parquet(kept)
    csv_ingest.load_batch(spark.read.parquet(kept), last, target, "orders")
    log = csv_ingest.file_log(spark, target, "orders")
    return log.groupBy(F.substring("file", 1, 8).alias("file")).agg(F.sum("rows").alias("rows"))


# --- C3-C5: the run log as written --------------------------------------------------------------

def _logs_after(spark, sf):
    """A store whose log was loaded, then updated by one run per script, while another writer came between."""
    store = PublishedTables(_run_dir(spark, "c3"))
    runs = _new_runs(spark, sf)
    store.publish({"logs": run_logs(spark, sf).select(*control.LOG_COLUMNS)})
    seen = store.manifest(spark)
    store.publish({"other": runs.limit(1)})
    try:
        store.publish({"logs": runs}, expected=seen.version)
    except StaleVersion:
        control.record_runs(spark, store, runs)
    return store, seen


@register("c3_written_run_log", ("C3", "C5"), oracle=ORACLES["c3_upsert_run_log"])
def c3_written_run_log(spark, sf):
    """The run log read back after its upsert was published."""
    return _logs_after(spark, sf)[0].read(spark, "logs")


@register("c3_reader_of_old_version", ("C3", "C5"), oracle=f"WITH {_LOGS_SQL} SELECT * FROM logs")
def c3_reader_of_old_version(spark, sf):
    """A reader that opened the log before the upsert still reads the old one."""
    store, seen = _logs_after(spark, sf)
    return store.read_from(spark, "logs", seen)


@register("c4_written_history", ("C4", "C5"), oracle=ORACLES["c4_append_history"].replace(
    "SELECT script_name, start_datetime, end_datetime, rundate, status, load_type FROM logs\nUNION ALL\nSELECT script_name, date_from, date_to, CAST(date_to AS DATE),",
    "SELECT script_name, date_from AS start_datetime, date_to AS end_datetime, CAST(date_to AS DATE) AS rundate,").replace("'Completed', load_type", "'Completed' AS status, load_type"))
def c4_written_history(spark, sf):
    """The history published with the log: one row per run."""
    return _logs_after(spark, sf)[0].read(spark, "logs_history")
