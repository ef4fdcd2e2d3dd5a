"""Series, validation and reshape queries: T1-T10, A4, A5, O3, O4, R1-R6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.dates import month_start
from ledgerspark.functions.text import date_text, datetime_text
from ledgerspark.operators import metrics, recon, series, validate
from ledgerspark.plans.catalog import register
from ledgerspark.session import table

CFG_PART = SeriesConfig("l_partkey", "l_shipdate", "l_quantity", "MS", min_history=24, test_size=12)
CFG_BRAND = SeriesConfig("p_brand", "l_shipdate", "l_quantity", "MS", min_history=24, test_size=12)
CFG_USER_DAILY = SeriesConfig("user_id", "ts", "value", "D", min_history=1, test_mode=False)

# Fixed coefficients for the T7 recursion check (oldest lag first).
AR_INTERCEPT = 5.0
AR_COEFS = (0.1, 0.3, 0.5)


def part_input(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_partkey", "l_shipdate", F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"))


def brand_input(spark, sf):
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "p_brand", "l_shipdate", F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"))


def _as_double(df, cfg):
    return df.select(cfg.dimension_col, cfg.date_col, F.col(cfg.value_col).cast("double").alias(cfg.value_col))


# ---- SQL building blocks for the oracles --------------------------------------------------------

_PART_SUMS = """
s AS (SELECT l_partkey, date_trunc('month', l_shipdate) AS d, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v
      FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_partkey, min(d) AS lo, max(d) AS hi FROM s GROUP BY 1),
axis AS (SELECT l_partkey, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d,
                len(generate_series(lo, hi, INTERVAL 1 MONTH)) AS n FROM b),
f AS (SELECT a.l_partkey, a.d, a.n, CAST(coalesce(s.v, 0) AS DOUBLE) AS v,
             row_number() OVER (PARTITION BY a.l_partkey ORDER BY a.d DESC) AS rn
      FROM axis a LEFT JOIN s ON a.l_partkey = s.l_partkey AND a.d = s.d)
"""

_BRAND_SUMS = """
s AS (SELECT p_brand, date_trunc('month', l_shipdate) AS d, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
b AS (SELECT p_brand, min(d) AS lo, max(d) AS hi FROM s GROUP BY 1),
axis AS (SELECT p_brand, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d,
                len(generate_series(lo, hi, INTERVAL 1 MONTH)) AS n FROM b),
f AS (SELECT a.p_brand, a.d, a.n, CAST(coalesce(s.v, 0) AS DOUBLE) AS v,
             row_number() OVER (PARTITION BY a.p_brand ORDER BY a.d DESC) AS rn
      FROM axis a LEFT JOIN s ON a.p_brand = s.p_brand AND a.d = s.d)
"""


@register("t1_resample_part_monthly", ("T1", "A5", "O3"), oracle=f"""
WITH {_PART_SUMS}
SELECT l_partkey, d AS l_shipdate, v AS l_quantity FROM f
""")
def t1_resample_part_monthly(spark, sf):
    return _as_double(series.resample(part_input(spark, sf), CFG_PART), CFG_PART)


@register("t1_resample_user_daily", ("T1",), oracle="""
WITH s AS (SELECT user_id, date_trunc('day', ts) AS d, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2),
b AS (SELECT user_id, min(d) AS lo, max(d) AS hi FROM s GROUP BY 1),
axis AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)
SELECT a.user_id, a.d AS ts, CAST(coalesce(s.v, 0) AS DOUBLE) AS value
FROM axis a LEFT JOIN s ON a.user_id = s.user_id AND a.d = s.d
""")
def t1_resample_user_daily(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    return _as_double(series.resample(ev, CFG_USER_DAILY), CFG_USER_DAILY)


@register("a4_members_brand", ("A4",), oracle="""
SELECT DISTINCT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def a4_members_brand(spark, sf):
    return recon.members(brand_input(spark, sf), "p_brand")


@register("t2_t3_split_part", ("T2", "T3"), oracle=f"""
WITH {_PART_SUMS}
SELECT l_partkey, d AS l_shipdate, v AS l_quantity, CASE WHEN rn <= 12 THEN 'test' ELSE 'train' END AS split
FROM f WHERE n >= 24
""")
def t2_t3_split_part(spark, sf):
    out = series.prepare(part_input(spark, sf), CFG_PART)
    return out.select("l_partkey", "l_shipdate", F.col("l_quantity").cast("double").alias("l_quantity"), "split")


@register("o4_last_12_brand", ("O4",), oracle=f"""
WITH {_BRAND_SUMS}
SELECT p_brand, d AS l_shipdate, v AS l_quantity FROM f WHERE rn <= 12
""")
def o4_last_12_brand(spark, sf):
    res = _as_double(series.resample(brand_input(spark, sf), CFG_BRAND), CFG_BRAND)
    return recon.last_n(res, "p_brand", "l_shipdate", 12)


def _array_text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("decimal(18,2)").cast("string")), ",")


@register("t4_windows_brand", ("T4",), oracle=f"""
WITH {_BRAND_SUMS},
w AS (SELECT p_brand, d, v, list(v) OVER (PARTITION BY p_brand ORDER BY d ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS x
      FROM f)
SELECT p_brand, d AS l_shipdate, array_to_string(list_transform(x, lambda e: CAST(CAST(e AS DECIMAL(18,2)) AS VARCHAR)), ',') AS X,
       v AS y
FROM w WHERE len(x) = 12
""")
def t4_windows_brand(spark, sf):
    res = series.resample(brand_input(spark, sf), CFG_BRAND)
    win = series.supervised_windows(res, CFG_BRAND)
    return win.select("p_brand", "l_shipdate", _array_text(F.col("X")).alias("X"), "y")


@register("t5_minmax_brand", ("T5",), oracle=f"""
WITH {_BRAND_SUMS},
g AS (SELECT p_brand, d, v, CASE WHEN rn <= 12 THEN 'test' ELSE 'train' END AS split FROM f WHERE n >= 24),
m AS (SELECT p_brand, min(v) AS lo, max(v) AS hi FROM g WHERE split = 'train' GROUP BY 1),
z AS (SELECT g.*, lo, hi, CASE WHEN hi - lo <> 0 THEN (v - lo) / (hi - lo) ELSE 0.0 END AS sc FROM g JOIN m USING (p_brand))
SELECT p_brand, d AS l_shipdate, split, round(sc, 9) AS scaled, round(sc * (hi - lo) + lo, 6) AS restored FROM z
""")
def t5_minmax_brand(spark, sf):
    prep = series.prepare(brand_input(spark, sf), CFG_BRAND)
    sc = series.minmax_scale(prep, CFG_BRAND)
    restored = series.minmax_inverse(F.col("scaled"), F.col("_min"), F.col("_max"))
    return sc.select("p_brand", "l_shipdate", "split", F.round("scaled", 9).alias("scaled"),
                     F.round(restored, 6).alias("restored"))


@register("t6_future_axis_brand", ("T6",), oracle=f"""
WITH {_BRAND_SUMS},
last AS (SELECT p_brand, max(d) AS last_date FROM f WHERE n >= 24 AND rn > 12 GROUP BY 1)
SELECT p_brand, CAST(k AS INTEGER) AS k, last_date + to_months(CAST(k AS INTEGER)) AS l_shipdate
FROM last, range(1, 13) t(k)
""")
def t6_future_axis_brand(spark, sf):
    prep = series.prepare(brand_input(spark, sf), CFG_BRAND)
    last = prep.filter(F.col("split") == "train").groupBy("p_brand").agg(F.max("l_shipdate").alias("last_date"))
    return series.future_axis(last, CFG_BRAND).select("p_brand", F.col("k").cast("int").alias("k"), "l_shipdate")


@register("t7_recursive_ar_brand", ("T7",), oracle=f"""
WITH RECURSIVE {_BRAND_SUMS},
base AS (SELECT p_brand,
                max(CASE WHEN rn = 15 THEN v END) AS a, max(CASE WHEN rn = 14 THEN v END) AS b,
                max(CASE WHEN rn = 13 THEN v END) AS c
         FROM f WHERE n >= 24 GROUP BY 1),
r AS (SELECT p_brand, 0 AS k, a, b, c FROM base
      UNION ALL
      SELECT p_brand, k + 1, b, c,
             {AR_INTERCEPT} + (((0.0 + {AR_COEFS[0]} * a) + {AR_COEFS[1]} * b) + {AR_COEFS[2]} * c)
      FROM r WHERE k < 12)
SELECT p_brand, CAST(k AS INTEGER) AS k, round(c, 6) AS l_quantity FROM r WHERE k >= 1
""")
def t7_recursive_ar_brand(spark, sf):
    prep = series.prepare(brand_input(spark, sf), CFG_BRAND)
    train = prep.filter(F.col("split") == "train")
    tail = recon.last_n(train, "p_brand", "l_shipdate", len(AR_COEFS))
    hist = tail.groupBy("p_brand").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_shipdate", F.col("l_quantity").cast("double").alias("l_quantity")))),
                    lambda s: s["l_quantity"]).alias("hist"))
    coefs = F.array(*[F.lit(c) for c in AR_COEFS])
    fc = series.recursive_forecast(F.col("hist"), coefs, F.lit(AR_INTERCEPT), 12)
    return hist.select("p_brand", F.posexplode(fc).alias("k", "l_quantity")).select(
        "p_brand", (F.col("k") + 1).cast("int").alias("k"), F.round("l_quantity", 6).alias("l_quantity"))


def _naive_sql(dim_sql: str, sums: str) -> str:
    return f"""
WITH {sums},
g AS (SELECT {dim_sql} AS series, d, v, rn, lag(v, 12) OVER (PARTITION BY {dim_sql} ORDER BY d) AS p
      FROM f WHERE n >= 24),
t AS (SELECT * FROM g WHERE rn <= 12)
SELECT 'SeasonalNaive' AS Model, series,
       round(sqrt(avg((v - p) * (v - p))), 6) AS RMSE,
       round(avg(abs(v - p)), 6) AS MAE,
       CASE WHEN max(CASE WHEN v = 0 THEN 1 ELSE 0 END) = 1 THEN NULL
            ELSE round(avg(abs((v - p) / v)) * 100, 6) END AS "MAPE (%)"
FROM t GROUP BY series
"""


def _naive_scores(spark, sf, level: str = "part"):
    """Seasonal-naive forecast (value 12 periods earlier) scored on the hold-out."""
    cfg, inp = (CFG_PART, part_input) if level == "part" else (CFG_BRAND, brand_input)
    dim = cfg.dimension_col
    prep = series.prepare(inp(spark, sf), cfg).select(
        F.col(dim).cast("string").alias("series"), "period_idx", "split",
        F.col("l_quantity").cast("double").alias("actual"))
    earlier = prep.select("series", (F.col("period_idx") + 12).alias("period_idx"),
                          F.col("actual").alias("predicted"))
    pairs = prep.filter(F.col("split") == "test").join(earlier, ["series", "period_idx"], "inner")
    scored = metrics.score(pairs.withColumn("Model", F.lit("SeasonalNaive")), ["Model", "series"])
    return scored.select("Model", "series", *[F.round(c, 6).alias(c) for c in ("RMSE", "MAE", "MAPE (%)")])


_PART_SCORES = _naive_sql("CAST(l_partkey AS VARCHAR)", _PART_SUMS)
_BRAND_SCORES = _naive_sql("p_brand", _BRAND_SUMS)


@register("t8_t10_scores_part", ("T8", "T9", "T10", "R6"), oracle=_PART_SCORES)
def t8_t10_scores_part(spark, sf):
    return validate.nonfinite_metrics_to_null(_naive_scores(spark, sf, "part"))


@register("r5_clean_scores", ("R5",), oracle=f"""
SELECT * FROM (({_PART_SCORES}) UNION ALL ({_BRAND_SCORES})) u
WHERE RMSE IS NOT NULL AND MAE IS NOT NULL AND "MAPE (%)" IS NOT NULL
""")
def r5_clean_scores(spark, sf):
    both = _naive_scores(spark, sf, "part").unionByName(_naive_scores(spark, sf, "brand"))
    return validate.clean_metrics(both)


# ---- R1: wide sheet -> long ---------------------------------------------------------------------

ROWS_A_TASK = 500_000


def wide_sales_sheet(spark, sf):
    """A wide monthly sheet derived from the tables: nine leading columns
    (Material among them), then one column per month present in lineitem. Its tasks grow in number and not in size:
    about ``ROWS_A_TASK`` lineitem rows each, all of a part in one."""
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    month = F.coalesce(F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1, F.lit(-1))
    monthly = li.select("l_partkey", month.alias("m"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    counted = {r.m: r.n for r in monthly.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}  # bounded: one per month
    months = sorted(counted)
    n = max(spark.sparkContext.defaultParallelism, -(-sum(counted.values()) // ROWS_A_TASK))
    sums = monthly.repartition(n, "l_partkey").groupBy("l_partkey", "m").agg(F.sum("q").cast("double").alias("v"))
    # a part's cells are one map until its row is named: a pivot holds full rows of months of every part in each task
    cells = sums.groupBy("l_partkey").agg(F.map_from_entries(F.collect_list(F.struct("m", "v"))).alias("cells"))
    lead = part.select(
        "p_partkey", "p_name", F.col("p_brand").alias("Material"), "p_type", "p_size", "p_retailprice",
        F.lit("PL01").alias("Plant"), F.lit("EA").alias("Unit"), F.lit("USD").alias("Currency"))
    row = F.transform(F.array(*map(F.lit, months)), lambda m: F.col("cells")[m])
    names = ["null" if m < 0 else f"{m // 12:04d}-{m % 12 + 1:02d}-01" for m in months]
    return (lead.join(cells, lead.p_partkey == cells.l_partkey, "left").select(*lead.columns, row.alias("row"))
            .select(*lead.columns, *[F.get("row", F.lit(i)).alias(name) for i, name in enumerate(names)]))


@register("r1_wide_to_long", ("R1", "S5"), oracle="""
WITH months AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-01') AS m FROM lineitem),
q AS (SELECT l_partkey, strftime(l_shipdate, '%Y-%m-01') AS m, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v
      FROM lineitem GROUP BY 1, 2)
SELECT p_brand AS Material, months.m AS Date, CAST(q.v AS DOUBLE) AS Sales
FROM part CROSS JOIN months LEFT JOIN q ON q.l_partkey = p_partkey AND q.m = months.m
""")
def r1_wide_to_long(spark, sf):
    return validate.reshape_wide(wide_sales_sheet(spark, sf), "Material", 9, "Date", "Sales")


@register("r2_r3_year_month_date", ("R2", "R3"), oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS YEAR, CAST(month(o_orderdate) AS INTEGER) AS MONTH,
       make_timestamp(year(o_orderdate), month(o_orderdate), 1, 0, 0, 0) AS Date
FROM orders
""")
def r2_r3_year_month_date(spark, sf):
    o = table(spark, sf, "orders")
    o = o.withColumn("YEAR", F.year("o_orderdate")).withColumn("MONTH", F.month("o_orderdate"))
    return o.withColumn("Date", month_start("YEAR", "MONTH"))


# ---- R4: validation with reasons ----------------------------------------------------------------

CFG_RAW = SeriesConfig("Product", "Date", "Amount", "MS")


def raw_long_table(spark, sf):
    """Orders as a raw (Product, Date, Amount) text table with every edge value
    the validation must handle, injected by fixed rules on the order key."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    product = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    date = (F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 11 == 1, F.lit("not a date"))
            .when(k % 11 == 2, F.concat_ws("/", F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0"),
                                            F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
                                            F.year("o_orderdate").cast("string")))
            .when(k % 11 == 3, datetime_text("o_orderdate"))
            .otherwise(date_text("o_orderdate")))
    amount = (F.when(k % 13 == 0, F.lit(None).cast("string"))
              .when(k % 13 == 1, F.lit("")).when(k % 13 == 2, F.lit("nan"))
              .when(k % 13 == 3, F.lit("1,000")).when(k % 13 == 4, F.lit(" 12 "))
              .when(k % 13 == 5, F.lit("inf")).when(k % 13 == 6, F.lit("1d"))
              .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    return o.select("o_orderkey", product.alias("Product"), date.alias("Date"), amount.alias("Amount"))


_RAW_SQL = r"""
raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS Product,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN 'not a date'
         WHEN o_orderkey % 11 = 2 THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN o_orderkey % 11 = 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN ''
         WHEN o_orderkey % 13 = 2 THEN 'nan' WHEN o_orderkey % 13 = 3 THEN '1,000'
         WHEN o_orderkey % 13 = 4 THEN ' 12 ' WHEN o_orderkey % 13 = 5 THEN 'inf'
         WHEN o_orderkey % 13 = 6 THEN '1d'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS Amount
  FROM orders),
st AS (SELECT *, regexp_replace(Amount, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS s FROM raw),
flagged AS (
  SELECT o_orderkey, Product,
    coalesce(try_strptime(Date, '%Y-%m-%d %H:%M:%S'), try_strptime(Date, '%Y-%m-%d')) AS Date, Amount,
    coalesce((regexp_full_match(s, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
              AND isfinite(TRY_CAST(s AS DOUBLE))
              AND (regexp_extract(s, '[eE]([+-]?[0-9]+)$', 1) = ''
                   OR coalesce(TRY_CAST(regexp_extract(s, '[eE]([+-]?[0-9]+)$', 1) AS BIGINT)
                               - length(regexp_extract(s, '^[+-]?[0-9]*\.?([0-9]*)', 1)) <= 308,
                               starts_with(regexp_extract(s, '[eE]([+-]?[0-9]+)$', 1), '-'))))
             OR regexp_full_match(Amount, '[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?'), false) AS ok_num
  FROM st),
f2 AS (
  SELECT *, concat(
    CASE WHEN Product IS NULL THEN 'Missing Product; ' ELSE '' END,
    CASE WHEN Date IS NULL THEN 'Invalid Date; ' ELSE '' END,
    CASE WHEN Amount IS NULL THEN 'Missing Amount; ' ELSE '' END,
    CASE WHEN NOT ok_num THEN 'Non-numeric Amount; ' ELSE '' END) AS Error_Flag
  FROM flagged)
"""


@register("r4_validation_errors", ("R4",), oracle=f"""
WITH {_RAW_SQL}
SELECT o_orderkey, Product, Date, Amount, Error_Flag FROM f2 WHERE Error_Flag <> ''
""")
def r4_validation_errors(spark, sf):
    _clean, errors, _m = validate.validate_split(raw_long_table(spark, sf), CFG_RAW)
    return errors


@register("r4_validation_clean", ("R4",), oracle=f"""
WITH {_RAW_SQL}
SELECT o_orderkey, Product, Date,
       CAST(regexp_replace(Amount, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS DOUBLE) AS Amount
FROM f2 WHERE Error_Flag = ''
""")
def r4_validation_clean(spark, sf):
    clean, _errors, _m = validate.validate_split(raw_long_table(spark, sf), CFG_RAW)
    return clean
