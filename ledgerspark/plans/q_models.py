"""Forecast-model queries: M1-M7, T11, T12 and the composed forecasts D11-D13."""

from __future__ import annotations

import itertools
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.dates import month_start
from ledgerspark.functions.text import date_text, datetime_text
from ledgerspark.models import holt_winters, runner
from ledgerspark.operators import series, validate
from ledgerspark.plans.catalog import register
from ledgerspark.plans.q_series import _BRAND_SUMS, CFG_BRAND, brand_input, wide_sales_sheet
from ledgerspark.session import scratch_table_path, table
from ledgerspark.sinks.files import write_csv
from ledgerspark.sinks.publish import PublishedTables
from ledgerspark.sources.files import read_wide_sheet


CFG_BRAND_FUTURE = replace(CFG_BRAND, test_mode=False)


def _forecast(spark, sf, model, cfg=CFG_BRAND):
    prep = series.prepare(brand_input(spark, sf), cfg)
    out = runner.run_models(prep, cfg, [model])
    return out.filter(F.col("error").isNull()).select(
        "p_brand", "l_shipdate", F.round("l_quantity", 4).alias("l_quantity"), "Model")


@register("m1_prophet_forecast_brand", ("M1", "T12"))
def m1_prophet(spark, sf):
    return _forecast(spark, sf, "Prophet")


_GRID_SQL = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)"
                      for a, b, c in itertools.product(CFG_BRAND.smoothing_grid, repeat=3))


_HW_SQL = f"""
WITH RECURSIVE {_BRAND_SUMS},
tr AS (SELECT p_brand, d, v, row_number() OVER (PARTITION BY p_brand ORDER BY d) AS i FROM f WHERE n >= 24 AND rn > 12),
cnt AS (SELECT p_brand, count(*) AS nt, max(d) AS last_date FROM tr GROUP BY 1 HAVING count(*) >= 24),
first AS (SELECT p_brand, list(v ORDER BY i) AS f12 FROM tr WHERE i <= 12 GROUP BY 1),
init AS (SELECT p_brand, f12, list_reduce(f12, lambda acc, x: acc + x) / 12 AS l0 FROM first),
grid AS (SELECT * FROM (VALUES {_GRID_SQL}) g(a, b, c)),
r AS (
  SELECT i0.p_brand, g.a, g.b, g.c, 12 AS i, i0.l0 AS l, 0.0::DOUBLE AS t,
         list_transform(i0.f12, lambda x: x - i0.l0) AS s, 0.0::DOUBLE AS sse
  FROM init i0 JOIN cnt ON cnt.p_brand = i0.p_brand, grid g
  UNION ALL
  SELECT r.p_brand, r.a, r.b, r.c, r.i + 1,
         r.a * (tr.v - r.s[1]) + (1 - r.a) * (r.l + r.t),
         r.b * ((r.a * (tr.v - r.s[1]) + (1 - r.a) * (r.l + r.t)) - r.l) + (1 - r.b) * r.t,
         list_append(r.s[2:12], r.c * (tr.v - (r.a * (tr.v - r.s[1]) + (1 - r.a) * (r.l + r.t))) + (1 - r.c) * r.s[1]),
         r.sse + (tr.v - (r.l + r.t + r.s[1])) * (tr.v - (r.l + r.t + r.s[1]))
  FROM r JOIN tr ON tr.p_brand = r.p_brand AND tr.i = r.i + 1),
fin AS (SELECT r.*, cnt.last_date FROM r JOIN cnt ON cnt.p_brand = r.p_brand AND r.i = cnt.nt),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY sse, a, b, c) AS k0 FROM fin) q
         WHERE k0 = 1)
SELECT p_brand, last_date + to_months(CAST(k AS INTEGER)) AS l_shipdate,
       round(l + k * t + s[((k - 1) % 12) + 1], 4) AS l_quantity, 'Holt-Winters' AS Model
FROM best, range(1, 13) h(k)
"""


@register("m2_holt_winters_forecast_brand", ("M2", "T6"), oracle=f"""{_HW_SQL}""")
def m2_holt_winters(spark, sf):
    return _forecast(spark, sf, "Holt-Winters")


_HELD_OUT = "WHERE n >= 24 AND rn > 12"


@register("m2_holt_winters_future_brand", ("M2", "T6"), oracle=_HW_SQL.replace(_HELD_OUT, "WHERE n >= 24"))
def m2_holt_winters_future(spark, sf):
    """All periods train; the next ``forecast_periods`` are forecast."""
    return _forecast(spark, sf, "Holt-Winters", CFG_BRAND_FUTURE)


def _result_sql(part):
    return f"""
WITH {_BRAND_SUMS}
SELECT d AS l_shipdate, v AS l_quantity, p_brand, 'Holt-Winters' AS Model FROM f WHERE n >= 36 AND {part}
"""


@register("t11_train_rows_brand", ("T11",), oracle=_result_sql("rn > 12"))
def t11_train_rows_brand(spark, sf):
    return runner.backtest(brand_input(spark, sf), CFG_BRAND, ["Holt-Winters"])["train"]


@register("t11_test_rows_brand", ("T11",), oracle=_result_sql("rn <= 12"))
def t11_test_rows_brand(spark, sf):
    return runner.backtest(brand_input(spark, sf), CFG_BRAND, ["Holt-Winters"])["test"]


_HW_SCORES_SQL = _HW_SQL.replace("""SELECT p_brand, last_date + to_months(CAST(k AS INTEGER)) AS l_shipdate,
       round(l + k * t + s[((k - 1) % 12) + 1], 4) AS l_quantity, 'Holt-Winters' AS Model
FROM best, range(1, 13) h(k)""", """, fc AS (SELECT p_brand, last_date + to_months(CAST(k AS INTEGER)) AS d, l + k * t + s[((k - 1) % 12) + 1] AS p
            FROM best, range(1, 13) h(k))
SELECT 'Holt-Winters' AS Model, f.p_brand,
       round(sqrt(avg((f.v - fc.p) * (f.v - fc.p))), 6) AS RMSE, round(avg(abs(f.v - fc.p)), 6) AS MAE,
       CASE WHEN max(CASE WHEN f.v = 0 THEN 1 ELSE 0 END) = 1 THEN NULL
            ELSE round(avg(abs((f.v - fc.p) / f.v)) * 100, 6) END AS "MAPE (%)"
FROM f JOIN fc ON f.p_brand = fc.p_brand AND f.d = fc.d
WHERE f.n >= 24 AND f.rn <= 12
GROUP BY f.p_brand""")


@register("m2_backtest_scores_brand", ("M2", "T8", "T9", "T10", "T11", "R5"), oracle=f"""
SELECT * FROM ({_HW_SCORES_SQL}) q WHERE RMSE IS NOT NULL AND MAE IS NOT NULL AND "MAPE (%)" IS NOT NULL
""")
def m2_backtest_scores_brand(spark, sf):
    """SURVEY 7.2's minimum slice: lineitem x part -> monthly quantity per brand ->
    T1-T3 (24/12) -> Holt-Winters -> RMSE / MAE / MAPE on the hold-out."""
    res = runner.backtest(brand_input(spark, sf), CFG_BRAND, ["Holt-Winters"])
    return res["forecast_error"].select("Model", "p_brand", *[F.round(c, 6).alias(c)
                                                             for c in ("RMSE", "MAE", "MAPE (%)")])


@register("m3_sarima_forecast_brand", ("M3", "T12"))
def m3_sarima(spark, sf):
    return _forecast(spark, sf, "SARIMA")


_ARIMA_SUMS = ", ".join(f"coalesce(sum(CASE WHEN z5 IS NOT NULL THEN z{i} * z{j} END), 0.0) AS s{i}{j}"
                        for i in range(6) for j in range(i, 6))
_ARIMA_AUG = "[" + ", ".join("[" + ", ".join(f"s{min(i, j)}{max(i, j)}" for j in range(1, 6)) + f", s0{i}]"
                             for i in range(1, 6)) + "]"


_ARIMA_SQL = f"""
WITH RECURSIVE {_BRAND_SUMS},
tr AS (SELECT p_brand, d, v FROM f WHERE n >= 24 AND rn > 12),
zz AS (SELECT p_brand, d, v, v - lag(v, 1) OVER (PARTITION BY p_brand ORDER BY d) AS z0 FROM tr),
z AS (SELECT *, lag(z0, 1) OVER w AS z1, lag(z0, 2) OVER w AS z2, lag(z0, 3) OVER w AS z3,
             lag(z0, 4) OVER w AS z4, lag(z0, 5) OVER w AS z5
      FROM zz WINDOW w AS (PARTITION BY p_brand ORDER BY d)),
agg AS (SELECT p_brand, count(*) AS n_train, max(d) AS last_date,
               arg_max(struct_pack(y := v, z0 := z0, z1 := z1, z2 := z2, z3 := z3, z4 := z4), d) AS lst,
               {_ARIMA_SUMS}
        FROM z GROUP BY p_brand),
el AS (SELECT p_brand, 0 AS k, {_ARIMA_AUG} AS m FROM agg WHERE n_train >= 11
       UNION ALL
       SELECT p_brand, k + 1,
              list_transform(m, lambda row, i: CASE WHEN i <= k + 1 THEN row
                   ELSE list_transform(row, lambda x, j: x - (row[k + 1] / m[k + 1][k + 1]) * m[k + 1][j]) END)
       FROM el WHERE k < 4),
up AS (SELECT p_brand, m FROM el WHERE k = 4),
bs AS (SELECT p_brand, m, 6 AS i, []::DOUBLE[] AS x FROM up
       UNION ALL
       SELECT p_brand, m, i - 1,
              list_prepend((m[i - 1][6] - list_reduce(list_prepend(0.0::DOUBLE,
                   list_transform(x, lambda xv, j: m[i - 1][i - 1 + j] * xv)), lambda a, b: a + b)) / m[i - 1][i - 1], x)
       FROM bs WHERE i > 1),
coef AS (SELECT p_brand, list_reverse(x) AS crev FROM bs WHERE i = 1),
fc AS (SELECT a.p_brand, 0 AS k, [a.lst.z4, a.lst.z3, a.lst.z2, a.lst.z1, a.lst.z0] AS w, a.lst.y AS lvl, c.crev,
              a.last_date
       FROM agg a JOIN coef c ON a.p_brand = c.p_brand
       UNION ALL
       SELECT p_brand, k + 1,
              list_append(w[2:5], 0.0 + list_reduce(list_prepend(0.0::DOUBLE, list_transform(w, lambda wv, j: crev[j] * wv)), lambda a, b: a + b)),
              lvl + (0.0 + list_reduce(list_prepend(0.0::DOUBLE, list_transform(w, lambda wv, j: crev[j] * wv)), lambda a, b: a + b)),
              crev, last_date
       FROM fc WHERE k < 12)
SELECT p_brand, last_date + to_months(CAST(k AS INTEGER)) AS l_shipdate, round(lvl, 4) AS l_quantity,
       'ARIMA' AS Model
FROM fc WHERE k >= 1
"""


@register("m4_arima_future_brand", ("M4", "T7"), oracle=_ARIMA_SQL.replace(_HELD_OUT, "WHERE n >= 24"))
def m4_arima_future(spark, sf):
    return _forecast(spark, sf, "ARIMA", CFG_BRAND_FUTURE)


@register("m4_arima_forecast_brand", ("M4", "T7", "T12"), oracle=_ARIMA_SQL)
def m4_arima(spark, sf):
    return _forecast(spark, sf, "ARIMA")


@register("m5_mlp_forecast_brand", ("M5", "T4", "T7", "T12"))
def m5_mlp(spark, sf):
    return _forecast(spark, sf, "MLPRegressor")


@register("m6_lstm_forecast_brand", ("M6", "T4", "T5", "T7", "T12"))
def m6_lstm(spark, sf):
    return _forecast(spark, sf, "LSTM")


@register("m7_backtest_forecast_error_brand", ("M7", "T11", "T8", "T9", "T10", "R5"))
def m7_backtest(spark, sf):
    res = runner.backtest(brand_input(spark, sf), CFG_BRAND)
    return res["forecast_error"].select("Model", "p_brand", *[F.round(c, 4).alias(c) for c in ("RMSE", "MAE", "MAPE (%)")])


CFG_USER_HOLDOUT = SeriesConfig("user_id", "ts", "value", "D", min_history=24, test_size=12)


@register("t12_model_errors_user_daily", ("T12",), oracle="""
WITH s AS (SELECT user_id, date_trunc('day', ts) AS d FROM events GROUP BY 1, 2),
b AS (SELECT user_id, len(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS n FROM s GROUP BY 1)
SELECT user_id, 'Holt-Winters' AS Model,
       'train has ' || CAST(n - 12 AS VARCHAR) || ' periods; Holt-Winters needs 24' AS error
FROM b WHERE n >= 24 AND n - 12 < 24
""")
def t12_model_errors_user_daily(spark, sf):
    """Daily user series (30 days) with a 12-day hold-out are too short for
    Holt-Winters: each gets one error row; the stage does not fail."""
    ev = table(spark, sf, "events").select("user_id", "ts", "value")
    res = runner.backtest(ev, CFG_USER_HOLDOUT, ["Holt-Winters"])
    return res["errors"]


# ---- composed forecasts ------------------------------------------------------------------------

# values arrive as text and become DOUBLE: their sums must not depend on how the rows lie
CFG_SHEET = SeriesConfig("Material", "Date", "Sales", "MS", min_history=24, test_size=12, stable_sums=True)
CFG_DAILY = SeriesConfig("Product", "Date", "Amount ($)", "D", min_history=24, test_size=12, stable_sums=True)
CFG_RETAIL = SeriesConfig("ITEM CODE", "Date", "RETAIL SALES", "D", min_history=24, test_size=12, stable_sums=True)


@register("d11_monthly_sales_forecast", ("D11", "S5", "R1", "R4", "M7", "K1", "T11"))
def d11_monthly_sales_forecast(spark, sf):
    """Wide sheet from a file (S5) -> long (R1) -> validated (R4) -> six models per Material ->
    source, rejected rows and the four result tables loaded (K1); returns the
    loaded forecast table."""
    base = scratch_table_path(spark, f"d11/{uuid.uuid4().hex[:12]}")
    [path] = write_csv(wide_sales_sheet(spark, sf), f"{base}/source_file/monthly_sales", "sheet.csv")
    long = validate.reshape_wide(read_wide_sheet(spark, path), "Material", 9, "Date", "Sales")
    target = PublishedTables(f"{base}/stage")
    runner.forecast_and_load(long, CFG_SHEET, "monthly_sales", target)
    out = target.read(spark, "monthly_sales_forecast")
    return out.select("Date", F.round("Sales", 4).alias("Sales"), "Material", "Model")


def _loaded(spark, raw, cfg, script):
    """Validate, forecast with Prophet and load all result tables (K1); the loaded forecast."""
    target = PublishedTables(scratch_table_path(spark, f"{script}/{uuid.uuid4().hex[:12]}"))
    runner.forecast_and_load(raw, cfg, script, target, ["Prophet"])
    return target.read(spark, f"{script}_forecast")


@register("d12_daily_forecast", ("D12", "M1", "R4", "K1"))
def d12_daily_forecast(spark, sf):
    """Daily amounts per product (events stand in for the cosmetics sheet), Prophet."""
    ev = table(spark, sf, "events").select(
        F.col("event_type").alias("Product"), datetime_text("ts").alias("Date"),
        F.col("value").cast("string").alias("Amount ($)"))
    return _loaded(spark, ev, CFG_DAILY, "daily").select("Date", F.round("Amount ($)", 4).alias("Amount ($)"), "Product", "Model")


@register("d13_retail_forecast", ("D13", "R2", "M1", "R4", "K1"))
def d13_retail_forecast(spark, sf):
    """Monthly retail sales per item from YEAR and MONTH columns, resampled by
    day as the reference does (days between month starts become 0), Prophet."""
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    raw = li.join(part, li.l_partkey == part.p_partkey).select(
        F.year("l_shipdate").alias("YEAR"), F.month("l_shipdate").alias("MONTH"),
        F.col("p_brand").alias("ITEM CODE"), F.col("l_extendedprice").alias("RETAIL SALES"))
    raw = raw.withColumn("Date", date_text(month_start("YEAR", "MONTH"))) \
        .withColumn("RETAIL SALES", F.col("RETAIL SALES").cast("string"))
    raw = raw.select("Date", "ITEM CODE", "RETAIL SALES")
    return _loaded(spark, raw, CFG_RETAIL, "retail").select("Date", F.round("RETAIL SALES", 4).alias("RETAIL SALES"), "ITEM CODE", "Model")
