"""The same results where one key is larger than a task: T1 in segments, J4 with keys cut on both sides, sums that do not depend
on order (A5), padding by batch (L2), and the refined search of M2."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.numeric import round_money
from ledgerspark.models import runner
from ledgerspark.operators import recon, series, textprep
from ledgerspark.plans.catalog import register
from ledgerspark.plans.q_models import _HW_SQL
from ledgerspark.plans.q_series import CFG_BRAND, CFG_PART, _PART_SUMS, brand_input, part_input
from ledgerspark.plans.q_text import _PAIRS_SQL, _VOCAB_SQL, pair_texts
from ledgerspark.session import table

# --- T1 ---------------------------------------------------------------------------------------

CFG_HOURLY = SeriesConfig("l_returnflag", "l_shipdate", "l_quantity", "h", min_history=1, test_mode=False, segment_bins=1024)


@register("t1_resample_hourly_in_segments", ("T1", "A5"), oracle="""
WITH s AS (SELECT l_returnflag, date_trunc('hour', l_shipdate) AS d, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_returnflag, min(d) AS lo, max(d) AS hi FROM s GROUP BY 1),
axis AS (SELECT l_returnflag, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS d FROM b)
SELECT a.l_returnflag, a.d AS l_shipdate, CAST(coalesce(s.v, 0) AS DOUBLE) AS l_quantity,
       CAST(row_number() OVER (PARTITION BY a.l_returnflag ORDER BY a.d) - 1 AS INTEGER) AS period_idx, CAST(count(*) OVER (PARTITION BY a.l_returnflag) AS INTEGER) AS n_periods
FROM axis a LEFT JOIN s ON a.l_returnflag = s.l_returnflag AND a.d = s.d
""")
def t1_resample_hourly_in_segments(spark, sf):
    """Hourly bins of years in few series: every series is cut into segments of 1,024 bins, each a task's share."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"))
    out = series.resample(li, CFG_HOURLY)
    return out.withColumn("l_quantity", F.col("l_quantity").cast("double"))


@register("t2_t3_split_part_in_segments", ("T1", "T2", "T3"), oracle=f"""
WITH {_PART_SUMS}
SELECT l_partkey, d AS l_shipdate, v AS l_quantity, CASE WHEN rn <= 12 THEN 'test' ELSE 'train' END AS split FROM f WHERE n >= 24
""")
def t2_t3_split_part_in_segments(spark, sf):
    """The hold-out split on top of resampling in segments, of 16 months here so that every series has several."""
    out = series.prepare(part_input(spark, sf), replace(CFG_PART, segment_bins=16))
    return out.select("l_partkey", "l_shipdate", F.col("l_quantity").cast("double").alias("l_quantity"), "split")


# --- A5 -----------------------------------------------------------------------------------------

CFG_STABLE = SeriesConfig("p_brand", "l_shipdate", "l_extendedprice", "MS", stable_sums=True)


@register("a5_stable_double_sums", ("A5", "T1"), oracle="""
SELECT p_brand, date_trunc('month', l_shipdate) AS l_shipdate, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS l_extendedprice
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""")
def a5_stable_double_sums(spark, sf):
    """Monthly sums of DOUBLE amounts with equal bits however the rows lie."""
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.join(part, li.l_partkey == part.p_partkey).select("p_brand", "l_shipdate", "l_extendedprice")
    return series.period_sums(rows, CFG_STABLE).withColumn("l_extendedprice", F.round("l_extendedprice", 2))


# --- J4 -----------------------------------------------------------------------------------------

_SIDES_SQL = """
wms AS (SELECT DISTINCT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 3 = 0 THEN 'HOT' WHEN l_orderkey % 2 = 0 THEN 'k' || l_orderkey ELSE 'K' || l_orderkey END AS wms_key,
               l_orderkey AS w_order, l_linenumber AS w_line FROM lineitem WHERE l_orderkey % 3 <> 0 OR l_linenumber = 1),
ax AS (SELECT DISTINCT CASE WHEN o_orderkey % 41 = 0 THEN 'hot' WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'K' || o_orderkey END AS ax_key, o_orderkey AS a_order FROM orders)
"""
_RECONCILED_SQL = f"""
WITH {_SIDES_SQL}
SELECT w.*, a.* FROM wms w LEFT JOIN ax a ON lower(w.wms_key) = lower(a.ax_key)
UNION
SELECT w.*, a.* FROM ax a LEFT JOIN wms w ON lower(w.wms_key) = lower(a.ax_key)
"""


def _sides(spark, sf):
    """WMS and ERP rows whose keys differ in case, one key with many rows on both sides, and NULL keys."""
    k = F.col("l_orderkey")
    key = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).when(k % 3 == 0, "HOT")
           .when(k % 2 == 0, F.concat(F.lit("k"), k.cast("string"))).otherwise(F.concat(F.lit("K"), k.cast("string"))))
    wms = (table(spark, sf, "lineitem").filter((k % 3 != 0) | (F.col("l_linenumber") == 1))
           .select(key.alias("wms_key"), k.alias("w_order"), F.col("l_linenumber").alias("w_line"))
           .withColumn("w_hot", F.coalesce(F.lower("wms_key") == "hot", F.lit(False))))  # once a row, not once a pair
    o = F.col("o_orderkey")
    ax_key = F.when(o % 41 == 0, "hot").when(o % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("K"), o.cast("string")))
    return wms, table(spark, sf, "orders").select(ax_key.alias("ax_key"), o.alias("a_order"))


def _summed(rows):
    """The reconciled rows by kind of match, with sums that any wrong, lost or repeated pair changes. Rows of the hot key are summed
    without grouping, which is plain additions: looking up a pair's group takes longer than making the pair."""
    w, a, hot = F.col("w_order"), F.col("a_order"), F.coalesce("w_hot", F.lit(False))
    pair, none, no_a = w % 1009 * (a % 1013), F.lit(None).cast("bigint"), a.isNull()
    many = hot & w.isNotNull()
    one = rows.filter(many).agg(F.count(F.when(~no_a, 1)).alias("n"), F.sum(F.when(~no_a, w)).alias("w_sum"), F.sum(a).alias("a_sum"), F.sum(pair).alias("pair_sum"),
                                F.count(F.when(no_a, 1)).alias("n_no_a"), F.sum(F.when(no_a, w)).alias("w_sum_no_a"))
    hot_sums = one.select(F.inline(F.array(
        F.struct(F.lit("wa hot").alias("kind"), "n", "w_sum", "a_sum", "pair_sum"),
        F.struct(F.lit("w- hot").alias("kind"), F.col("n_no_a").alias("n"), F.col("w_sum_no_a").alias("w_sum"), none.alias("a_sum"), none.alias("pair_sum")))))
    sums = rows.filter(~many).groupBy(w.isNull().alias("no_w"), no_a.alias("no_a"), hot.alias("hot")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("w_sum"), F.sum(a).alias("a_sum"), F.sum(pair).alias("pair_sum"))
    kind = F.concat(F.when(F.col("no_w"), "-").otherwise("w"), F.when(F.col("no_a"), "-").otherwise("a"), F.when(F.col("hot"), " hot").otherwise(""))
    return sums.select(kind.alias("kind"), "n", "w_sum", "a_sum", "pair_sum").unionByName(hot_sums.filter(F.col("n") > 0))


_SUMMED_SQL = f"""
SELECT (CASE WHEN w_order IS NULL THEN '-' ELSE 'w' END) || (CASE WHEN a_order IS NULL THEN '-' ELSE 'a' END) || (CASE WHEN lower(wms_key) = 'hot' THEN ' hot' ELSE '' END) AS kind,
       count(*) AS n, CAST(sum(w_order) AS BIGINT) AS w_sum, CAST(sum(a_order) AS BIGINT) AS a_sum, CAST(sum(w_order % 1009 * (a_order % 1013)) AS BIGINT) AS pair_sum
FROM ({_RECONCILED_SQL}) GROUP BY 1
"""


@register("j4_reconcile_lower_keys", ("J4",), oracle=_SUMMED_SQL)
def j4_reconcile_lower_keys(spark, sf):
    """Reconciliation of keys without regard to case."""
    wms, ax = _sides(spark, sf)
    return _summed(recon.reconcile(wms, ax, rule="lower"))


@register("j4_reconcile_hot_key", ("J4",), oracle=_SUMMED_SQL)
def j4_reconcile_hot_key(spark, sf):
    """The same with keys of more than 500 rows on a side cut on both sides."""
    wms, ax = _sides(spark, sf)
    return _summed(recon.reconcile(wms, ax, rule="lower", split_rows=500))


# --- L2 -----------------------------------------------------------------------------------------

BATCH = 100


@register("l2_tokenize_padded_by_batch", ("L2", "L3"), oracle=f"""
WITH {_PAIRS_SQL}, {_VOCAB_SQL},
ids AS (SELECT t.pair_id, list(v.token_id ORDER BY t.pos) AS ids FROM toks t JOIN vocab v ON t.token = v.token WHERE t.pos <= 128 GROUP BY t.pair_id),
placed AS (SELECT pair_id, coalesce(ids, []) AS ids, CAST((row_number() OVER (ORDER BY pair_id) - 1) // {BATCH} AS BIGINT) AS batch FROM texts LEFT JOIN ids USING (pair_id)),
m AS (SELECT batch, max(len(ids)) AS L FROM placed GROUP BY batch),
V AS (SELECT count(*) AS V FROM vocab)
SELECT pair_id, placed.batch, array_to_string(list_resize(ids, L, V), ',') AS input_ids,
       array_to_string(list_resize(list_transform(ids, lambda x: 1), L, 0), ',') AS attention_mask, array_to_string(list_resize(ids, L, V), ',') AS labels
FROM placed JOIN m ON m.batch = placed.batch, V
""")
def l2_tokenize_padded_by_batch(spark, sf):
    """Token ids in batches of 100 pairs, each padded to its own longest row."""
    texts = pair_texts(spark, sf)
    tok = textprep.tokenize(texts, textprep.build_vocabulary(texts, "pair_id"), "pair_id", batch_rows=BATCH)
    return tok.select("pair_id", "batch", *[F.array_join(c, ",").alias(c) for c in ("input_ids", "attention_mask", "labels")])


# --- M2 -----------------------------------------------------------------------------------------

_FIRST, _LAST = _HW_SQL.split("SELECT p_brand, last_date + to_months", 1)
_REFINED_SQL = f"""{_FIRST.rstrip()},
step AS (SELECT * FROM (VALUES (-0.1::DOUBLE), (0.0::DOUBLE), (0.1::DOUBLE)) s(d)),
near AS (SELECT DISTINCT p_brand, greatest(least(best.a + x.d, 1.0::DOUBLE), 0.0::DOUBLE) AS a, greatest(least(best.b + y.d, 1.0::DOUBLE), 0.0::DOUBLE) AS b,
                greatest(least(best.c + z.d, 1.0::DOUBLE), 0.0::DOUBLE) AS c FROM best, step x, step y, step z),
r2 AS (
  SELECT i0.p_brand, g.a, g.b, g.c, 12 AS i, i0.l0 AS l, 0.0::DOUBLE AS t, list_transform(i0.f12, lambda x: x - i0.l0) AS s, 0.0::DOUBLE AS sse
  FROM init i0 JOIN near g ON g.p_brand = i0.p_brand
  UNION ALL
  SELECT r2.p_brand, r2.a, r2.b, r2.c, r2.i + 1,
         r2.a * (tr.v - r2.s[1]) + (1 - r2.a) * (r2.l + r2.t),
         r2.b * ((r2.a * (tr.v - r2.s[1]) + (1 - r2.a) * (r2.l + r2.t)) - r2.l) + (1 - r2.b) * r2.t,
         list_append(r2.s[2:12], r2.c * (tr.v - (r2.a * (tr.v - r2.s[1]) + (1 - r2.a) * (r2.l + r2.t))) + (1 - r2.c) * r2.s[1]),
         r2.sse + (tr.v - (r2.l + r2.t + r2.s[1])) * (tr.v - (r2.l + r2.t + r2.s[1]))
  FROM r2 JOIN tr ON tr.p_brand = r2.p_brand AND tr.i = r2.i + 1),
fin2 AS (SELECT r2.*, cnt.last_date FROM r2 JOIN cnt ON cnt.p_brand = r2.p_brand AND r2.i = cnt.nt),
best2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY sse, a, b, c) AS k0 FROM fin2) q WHERE k0 = 1)
SELECT p_brand, last_date + to_months{_LAST.replace("FROM best,", "FROM best2,")}"""


@register("m2_holt_winters_refined_brand", ("M2", "T6"), oracle=_REFINED_SQL)
def m2_holt_winters_refined_brand(spark, sf):
    """The grid's best point per series, refined by one round of the box around it."""
    cfg = replace(CFG_BRAND, smoothing_rounds=1)
    out = runner.run_models(series.prepare(brand_input(spark, sf), cfg), cfg, ["Holt-Winters"])
    return out.filter(F.col("error").isNull()).select("p_brand", "l_shipdate", F.round("l_quantity", 4).alias("l_quantity"), "Model")


# --- O2 -----------------------------------------------------------------------------------------

@register("o2_top_n_count", ("O2",), oracle="SELECT least(count(*), 1000) AS n, least(count(*), 1000) AS n_distinct FROM orders")
def o2_top_n_count(spark, sf):
    """How many rows, and how many different ones, an unordered TOP (1000) gives."""
    top = recon.top_n(table(spark, sf, "orders"), 1000)
    return top.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_distinct"))


# --- P12 ----------------------------------------------------------------------------------------

@register("p12_round_once", ("P12",), oracle="""
WITH t AS (SELECT l_orderkey, l_linenumber, l_orderkey % 1000 * 125 AS thousandths FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN thousandths % 10 = 5 AND l_linenumber < 4 THEN thousandths // 10 ELSE (thousandths + 5) // 10 END AS DOUBLE) / 100 AS rounded FROM t
""")
def p12_round_once(spark, sf):
    """Values on a half cent and 10**-11 beside it, rounded from all their digits."""
    x = (F.col("l_orderkey") % 1000).cast("double") / 8 + (F.col("l_linenumber") - 4).cast("double") * 1e-11
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", round_money(x).alias("rounded"))
