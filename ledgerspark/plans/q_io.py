"""Source, sink and movement queries: S4, S6, S7, K1-K11, D8-D10.

Each query runs a real load: it writes derived data to a fresh folder under
the shared checkpoint folder (``spark.checkpoint.dir``), reads it back through
the operator under test and returns what landed. No database is started, so
JDBC targets are stood in for by Parquet tables with the same write modes.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from ledgerspark.functions.dates import closed_window
from ledgerspark.operators import control, recon, sqlrun
from ledgerspark.plans.catalog import register
from ledgerspark.session import scratch_table_path, table
from ledgerspark.sinks import files as fsink
from ledgerspark.sinks import tables as tsink
from ledgerspark.sources import extract, files as fsrc
from ledgerspark.streaming import csv_ingest

LOAD_DATE = dt.date(2024, 2, 1)
ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")
LINE_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
               "l_linestatus string, l_shipdate timestamp_ntz")


def _run_dir(spark, name: str) -> str:
    return scratch_table_path(spark, f"{name}/{uuid.uuid4().hex[:12]}")


@register("s4_k7_csv_round_trip", ("S4", "K7"), oracle="SELECT * FROM orders")
def s4_k7_csv_round_trip(spark, sf):
    base = _run_dir(spark, "s4")
    [path] = fsink.write_csv(table(spark, sf, "orders"), os.path.join(base, "source_file", "s4"), "orders.csv")
    return fsrc.read_delimited(spark, path, ORDERS_SCHEMA)


@register("s6_json_pairs_round_trip", ("S6",), oracle="""
SELECT u.text AS prompt, a.text AS response
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'
""")
def s6_json_pairs_round_trip(spark, sf):
    from ledgerspark.operators.textprep import pair_turns
    path = _run_dir(spark, "s6")
    pair_turns(table(spark, sf, "conversations")).select("prompt", "response").write.json(path)
    return fsrc.read_json_pairs(spark, path, multiline=False)


@register("s7_two_sources_one_plan", ("S7",), oracle="""
SELECT c_mktsegment, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def s7_two_sources_one_plan(spark, sf):
    src = extract.extract_all({
        "sales": lambda: table(spark, sf, "lineitem"),
        "orders": lambda: table(spark, sf, "orders"),
        "customers": lambda: table(spark, sf, "customer"),
    })
    j = src["sales"].join(src["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        src["customers"], F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_lines"))


@register("d9_k1_k10_file_to_staging", ("D9", "K1", "K2", "K3", "K10", "S4"), oracle="""
SELECT 'd9' AS script_name, 'd9_lineitem' AS table_name, count(*) AS data_count, DATE '2024-02-01' AS date
FROM lineitem
UNION ALL
SELECT 'd9', 'd9_lineitem', count(*), DATE '2024-02-01' FROM lineitem
""")
def d9_file_to_staging(spark, sf):
    """CSV file -> staging table replaced, then appended again; one audit row per load."""
    base = _run_dir(spark, "d9")
    [csv] = fsink.write_csv(table(spark, sf, "lineitem"), os.path.join(base, "source_file", "d9"), "lineitem.csv")
    frame = fsrc.read_delimited(spark, csv, LINE_SCHEMA)
    target = tsink.ParquetTarget(os.path.join(base, "stage"))
    audit = tsink.ParquetTarget(os.path.join(base, "config"))
    tsink.append_audit(spark, "d9", tsink.upload({"lineitem": frame}, "d9", target, append=False), LOAD_DATE, audit)
    tsink.append_audit(spark, "d9", tsink.upload({"lineitem": frame}, "d9", target, append=True), LOAD_DATE, audit)
    return audit.read(spark, "data_count_log")


@register("d10_k4_window_to_target", ("D10", "K4", "C1", "P6", "K10"), oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate BETWEEN date_trunc('day', TIMESTAMP '2001-08-02 09:30:00' - INTERVAL 30 DAY)
                      AND TIMESTAMP '2001-08-02 09:30:00'
""")
def d10_window_to_target(spark, sf):
    """Date window from C1, source query filtered by it (pushed to the scan),
    moved to the target table, rows counted during the write."""
    start, end = control.date_range(30, dt.datetime(2001, 8, 2, 9, 30))
    src = table(spark, sf, "orders").filter(closed_window("o_orderdate", start, end))
    base = _run_dir(spark, "d10")
    target = tsink.ParquetTarget(base)
    n = tsink.transfer(src, target, "orders_window")
    tsink.append_audit(spark, "d10", {"orders_window": n}, LOAD_DATE, target)
    return target.read(spark, "orders_window")


@register("d8_merge_file_and_db_sales", ("D8", "Q0", "U2", "K1"), oracle="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
UNION
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE l_quantity + 100 END, l_extendedprice FROM lineitem
""")
def d8_merge_file_and_db_sales(spark, sf):
    """File sales + database sales merged by SQL UNION, loaded to staging."""
    base = _run_dir(spark, "d8")
    li = table(spark, sf, "lineitem")
    [csv] = fsink.write_csv(li, base, "file_sales")
    file_sales = fsrc.read_delimited(spark, csv, LINE_SCHEMA)
    # stands in for the database table: the same sales, some corrected
    db_sales = li.withColumn("l_quantity", F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(F.col("l_quantity") + 100))
    merged = sqlrun.run_sql(spark, """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM file_sales
        UNION
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM db_sales""",
                            file_sales=file_sales, db_sales=db_sales)
    target = tsink.ParquetTarget(os.path.join(base, "stage"))
    tsink.upload({"sales": merged}, "d8", target)
    return target.read(spark, "d8_sales")


@register("k5_csv_extraction", ("K5",), oracle="SELECT * FROM lineitem")
def k5_csv_extraction(spark, sf):
    base = _run_dir(spark, "k5")
    out = fsink.run_folder(base, "outbound", "k5", "extraction", as_of=dt.datetime(2024, 2, 1))
    fsink.extract_csv(table(spark, sf, "lineitem"), out, max_records=tsink.BATCH_TRANSFER)
    return fsrc.read_delimited(spark, out, LINE_SCHEMA)


@register("k6_streaming_csv_load", ("K6",), oracle="SELECT * FROM lineitem")
def k6_streaming_csv_load(spark, sf):
    """Landing folder of CSV files (by return flag) ingested incrementally
    into a table; processed files move to the archive folder."""
    base = _run_dir(spark, "k6")
    landing = os.path.join(base, "landing")
    li = table(spark, sf, "lineitem")
    for flag in ("A", "N", "R", "other"):
        own = F.coalesce(F.col("l_returnflag"), F.lit("")).isin("A", "N", "R")
        li.filter(F.col("l_returnflag") == flag if flag != "other" else ~own).write.option("header", True).csv(os.path.join(landing, flag))
    target = tsink.ParquetTarget(os.path.join(base, "stage"))
    csv_ingest.ingest_new_csv(spark, os.path.join(landing, "*"), LINE_SCHEMA, target, "lineitem",
                              os.path.join(base, "archive", LOAD_DATE.strftime("%Y%m%d")),
                              os.path.join(base, "_checkpoint"))
    return target.read(spark, "lineitem").drop("batch_id", csv_ingest.FILE)


@register("k8_named_export", ("K8",), oracle="""
SELECT 'nations' AS sheet, n_name AS name FROM nation
UNION ALL SELECT 'regions', r_name FROM region
""")
def k8_named_export(spark, sf):
    base = _run_dir(spark, "k8")
    paths = fsink.export_named([table(spark, sf, "nation").select(F.col("n_name").alias("name")),
                                table(spark, sf, "region").select(F.col("r_name").alias("name"))],
                               ["nations", "regions"], base)
    parts = [fsrc.read_delimited(spark, p, "name string").withColumn("sheet", F.lit(n)) for n, p in paths.items()]
    return recon.union_all(*parts).select("sheet", "name")


@register("k9_replace_tables_report", ("K9",), oracle="""
SELECT 'k9_part' AS table_name, count(*) AS row_count FROM part
UNION ALL SELECT 'k9_supplier', count(*) FROM supplier
""")
def k9_replace_tables_report(spark, sf):
    base = _run_dir(spark, "k9")
    return tsink.replace_tables(spark, {"k9_part": table(spark, sf, "part"),
                                        "k9_supplier": table(spark, sf, "supplier")}, location=base)


@register("k11_expire_day_folders", ("K11",), oracle="""
SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 7 DAY
UNION ALL SELECT NULL, 'notadate'
""")
def k11_expire_day_folders(spark, sf):
    """Events written in day folders; folders older than 7 days before the
    as-of date are deleted, a folder whose name is not a date is kept."""
    base = _run_dir(spark, "k11")
    ev = table(spark, sf, "events").select("event_id", fsink.day_partition(F.col("ts")).alias("day"))
    ev.write.partitionBy("day").parquet(base)
    spark.createDataFrame([(None,)], "event_id bigint").write.parquet(os.path.join(base, "day=notadate"))
    fsink.delete_expired_folders(spark, base, dt.date(2024, 1, 31), 7, key="day")
    # what is left in storage, with nothing filtered after the deletion
    return spark.read.parquet(base).select("event_id", F.col("day").cast("string").alias("day"))
