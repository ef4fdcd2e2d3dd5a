"""SQL-over-frames, look-back filters and incremental-load control queries:
Q0-Q3, P5, P6, C1-C5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.functions.dates import closed_window, lookback
from ledgerspark.operators import control, sqlrun
from ledgerspark.plans.catalog import AS_OF, register
from ledgerspark.session import table

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"
# The run logs derive from events (January 2024), so the control runs happen just after.
CONTROL_AS_OF = "2024-02-01 06:00:00"
CONTROL_AS_OF_DT = dt.datetime.fromisoformat(CONTROL_AS_OF)
CONTROL_AS_OF_SQL = f"TIMESTAMP '{CONTROL_AS_OF}'"


# ---- Q0-Q3 -------------------------------------------------------------------------------------

_SEGMENT_SQL = """
SELECT c_mktsegment, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM {o} JOIN {c} ON o_custkey = c_custkey
GROUP BY c_mktsegment
"""


@register("q0_sql_over_frames", ("Q0",), oracle=_SEGMENT_SQL.format(o="orders", c="customer"))
def q0_sql_over_frames(spark, sf):
    return sqlrun.run_sql(spark, _SEGMENT_SQL.format(o="o", c="c"),
                          o=table(spark, sf, "orders"), c=table(spark, sf, "customer"))


@register("q1_scalar_count", ("Q1", "S2"), oracle="""
SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""")
def q1_scalar_count(spark, sf):
    # the DataFrame behind df_count(); named parameters instead of pasted text
    return sqlrun.run_sql(spark, "SELECT count(*) AS count FROM o WHERE o_orderstatus = :st AND o_totalprice > :p",
                          args={"st": "F", "p": 100000}, o=table(spark, sf, "orders"))


@register("q2_record_count", ("Q2",), oracle="SELECT count(*) AS n_rows FROM lineitem")
def q2_record_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


_CTE_SQL = """
WITH big AS (SELECT o_orderkey, o_custkey FROM {o} WHERE o_totalprice > 150000),
     lines AS (SELECT l_orderkey, count(*) AS n_lines FROM {l} GROUP BY l_orderkey)
SELECT big.o_custkey, CAST(sum(lines.n_lines) AS BIGINT) AS n_lines, count(*) AS n_orders
FROM big JOIN lines ON big.o_orderkey = lines.l_orderkey
GROUP BY big.o_custkey
"""


@register("q3_cte", ("Q3",), oracle=_CTE_SQL.format(o="orders", l="lineitem"))
def q3_cte(spark, sf):
    return sqlrun.run_sql(spark, _CTE_SQL.format(o="o", l="li"),
                          o=table(spark, sf, "orders"), li=table(spark, sf, "lineitem"))


# ---- P5, P6, C1 --------------------------------------------------------------------------------

@register("p5_lookback_keep_time", ("P5",), oracle=f"""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= {AS_OF_SQL} - INTERVAL 90 DAY
""")
def p5_lookback_keep_time(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter(lookback("o_orderdate", AS_OF, 90)).select("o_orderkey", "o_orderdate")


@register("p5_lookback_midnight", ("P5",), oracle=f"""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= date_trunc('day', {AS_OF_SQL}) - INTERVAL 90 DAY
""")
def p5_lookback_midnight(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter(lookback("o_orderdate", AS_OF, 90, midnight=True)).select("o_orderkey", "o_orderdate")


@register("p6_c1_closed_window", ("P6", "C1"), oracle=f"""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN date_trunc('day', {AS_OF_SQL} - INTERVAL 30 DAY) AND {AS_OF_SQL}
""")
def p6_c1_closed_window(spark, sf):
    start, end = control.date_range(30, dt.datetime.fromisoformat(AS_OF))
    li = table(spark, sf, "lineitem")
    return li.filter(closed_window("l_shipdate", start, end)).select("l_orderkey", "l_linenumber", "l_shipdate")


# ---- C2-C5: run logs derived from events -------------------------------------------------------

def run_logs(spark, sf):
    """Run-log rows standing in for the logs table: one run per event, script
    = event_type, duration from the value."""
    ev = table(spark, sf, "events")
    end = F.col("ts") + F.make_interval(mins=F.floor("value").cast("int"))
    return ev.select(F.concat(F.lit("script_"), F.col("event_type")).alias("script_name"),
                     F.col("ts").alias("start_datetime"), end.alias("end_datetime"),
                     F.to_date(end).alias("rundate"), F.lit("Completed").alias("status"),
                     F.when(F.col("event_id") % 2 == 0, "full").otherwise("incremental").alias("load_type"))


_LOGS_SQL = """
logs AS (SELECT 'script_' || event_type AS script_name, ts AS start_datetime,
                ts + to_minutes(CAST(floor(value) AS INTEGER)) AS end_datetime,
                CAST(ts + to_minutes(CAST(floor(value) AS INTEGER)) AS DATE) AS rundate, 'Completed' AS status,
                CASE WHEN event_id % 2 = 0 THEN 'full' ELSE 'incremental' END AS load_type
         FROM events),
scripts AS (SELECT 'script_' || event_type AS script_name FROM events UNION SELECT 'script_' || r_name FROM region)
"""


def scripts_frame(spark, sf):
    """Every event type, and every region name as a script that has not run yet."""
    names = table(spark, sf, "events").select("event_type").unionByName(table(spark, sf, "region").select(F.col("r_name").alias("event_type")))
    return names.select(F.concat(F.lit("script_"), F.col("event_type")).alias("script_name"))


@register("c2_load_windows", ("C2",), oracle=f"""
WITH {_LOGS_SQL},
last AS (SELECT script_name, max(end_datetime) AS last_end FROM logs GROUP BY 1)
SELECT s.script_name, coalesce(last_end, TIMESTAMP '{control.date_range(6000, CONTROL_AS_OF_DT)[0]}') AS date_from,
       {CONTROL_AS_OF_SQL} AS date_to, CASE WHEN last_end IS NULL THEN 'full' ELSE 'incremental' END AS load_type
FROM scripts s LEFT JOIN last USING (script_name)
""")
def c2_load_windows(spark, sf):
    return control.load_windows(run_logs(spark, sf), scripts_frame(spark, sf), CONTROL_AS_OF_DT)


def _new_runs(spark, sf):
    """One new run per script: the window from C2 (full or incremental)."""
    w = control.load_windows(run_logs(spark, sf), scripts_frame(spark, sf), CONTROL_AS_OF_DT)
    return w.select("script_name", F.col("date_from").alias("start_datetime"), F.col("date_to").alias("end_datetime"),
                    F.to_date("date_to").alias("rundate"), F.lit("Completed").alias("status"), "load_type")


@register("c3_upsert_run_log", ("C3", "C5"), oracle=f"""
WITH {_LOGS_SQL},
last AS (SELECT script_name, max(end_datetime) AS last_end FROM logs GROUP BY 1),
runs AS (SELECT s.script_name, coalesce(last_end, TIMESTAMP '{control.date_range(6000, CONTROL_AS_OF_DT)[0]}') AS start_datetime,
                {CONTROL_AS_OF_SQL} AS end_datetime, CAST({CONTROL_AS_OF_SQL} AS DATE) AS rundate, 'Completed' AS status,
                CASE WHEN last_end IS NULL THEN 'full' ELSE 'incremental' END AS load_type
         FROM scripts s LEFT JOIN last USING (script_name))
SELECT l.script_name,
       CASE WHEN r.script_name IS NOT NULL THEN r.start_datetime ELSE l.start_datetime END AS start_datetime,
       CASE WHEN r.script_name IS NOT NULL THEN r.end_datetime ELSE l.end_datetime END AS end_datetime,
       CASE WHEN r.script_name IS NOT NULL THEN r.rundate ELSE l.rundate END AS rundate,
       CASE WHEN r.script_name IS NOT NULL THEN r.status ELSE l.status END AS status,
       CASE WHEN r.script_name IS NOT NULL THEN r.load_type ELSE l.load_type END AS load_type
FROM logs l LEFT JOIN (SELECT * FROM runs WHERE load_type <> 'full') r ON l.script_name = r.script_name
UNION ALL
SELECT * FROM runs WHERE load_type = 'full'
""")
def c3_upsert_run_log(spark, sf):
    return control.upsert_run_log(run_logs(spark, sf), _new_runs(spark, sf))


@register("c4_append_history", ("C4", "C5"), oracle=f"""
WITH {_LOGS_SQL},
last AS (SELECT script_name, max(end_datetime) AS last_end FROM logs GROUP BY 1),
w AS (SELECT s.script_name, coalesce(last_end, TIMESTAMP '{control.date_range(6000, CONTROL_AS_OF_DT)[0]}') AS date_from,
             {CONTROL_AS_OF_SQL} AS date_to, CASE WHEN last_end IS NULL THEN 'full' ELSE 'incremental' END AS load_type
      FROM scripts s LEFT JOIN last USING (script_name))
SELECT script_name, start_datetime, end_datetime, rundate, status, load_type FROM logs
UNION ALL
SELECT script_name, date_from, date_to, CAST(date_to AS DATE), 'Completed', load_type FROM w
""")
def c4_append_history(spark, sf):
    w = control.load_windows(run_logs(spark, sf), scripts_frame(spark, sf), CONTROL_AS_OF_DT)
    return control.append_history(run_logs(spark, sf), control.history_rows(w))
