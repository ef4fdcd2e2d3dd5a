"""One key larger than a task: segments of a series, keys cut on both sides, sums in any order, padding by batch."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter
from dataclasses import replace
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.config import FREQUENCIES, SeriesConfig
from ledgerspark.functions.dates import bin_number, bin_of_number, bin_start
from ledgerspark.functions.numeric import round_money
from ledgerspark.models import holt_winters, runner
from ledgerspark.operators import recon, series, textprep

CFG = SeriesConfig("a b", "when", "v", "D", min_history=1, test_mode=False)


def rows_of(df):
    return Counter(map(str, (tuple(r) for r in df.collect())))


# --- T1 -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("freq", sorted(FREQUENCIES))
def test_bins_and_their_numbers(spark, freq):
    days = spark.range(-3000, 3000).select((F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int") * 11, F.col("id").cast("int") % 24)).alias("t"))
    out = days.select(bin_start("t", freq).alias("b")).distinct().withColumn("n", bin_number("b", freq)).withColumn("again", bin_of_number("n", freq))
    assert out.filter("b <> again").count() == 0 and out.select("n").distinct().count() == out.count()
    step = FREQUENCIES[freq][1]
    assert out.withColumn("next", bin_number(F.expr(f"b + {step}"), freq)).filter("next <> n + 1").count() == 0


@pytest.mark.parametrize("freq, segment", [("h", 5), ("h", 1000), ("D", 1), ("D", 7), ("MS", 3), ("QS", 2), ("YS", 1)])
def test_segments_give_the_rows_of_whole_series(spark, freq, segment):
    rng = random.Random(freq)
    start = dt.datetime(1969, 11, 28, 22)
    rows = [("one", start, 1.5), ("one", start, 2.5), (None, start, 1.0), ("null date", None, 1.0), ("null value", start, None), ("dense", start, 0.25)]
    rows += [(f"s{rng.randrange(4)}", start + dt.timedelta(hours=rng.randrange(60 * 24)), rng.choice([None, 1.0, 2.25])) for _ in range(60)]
    rows += [("far", start, 1.0), ("far", start + dt.timedelta(days=300), 1.0)]
    df = spark.createDataFrame(rows, "`a b` string, when timestamp_ntz, v double")
    for typed in (df, df.withColumn("v", F.col("v").cast("decimal(10,2)"))):
        cfg = replace(CFG, freq=freq)
        for history in (None, 3):
            want = series.resample(typed, cfg, history)
            got = series.resample(typed, replace(cfg, segment_bins=segment), history)
            assert got.schema == want.schema or [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
            assert rows_of(got) == rows_of(want)
    assert series.resample(df.limit(0), replace(CFG, segment_bins=4)).count() == 0


def test_one_long_series_spreads_over_tasks(spark):
    hours = spark.range(0, 200_000, 7).select(F.lit("x").alias("a b"), (F.lit(dt.datetime(1990, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("when"), F.lit(1).alias("v"))
    out = series.resample(hours, replace(CFG, freq="h", segment_bins=1024))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(sizes) == 199_998
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2


# --- A5 -------------------------------------------------------------------------------------------

def bits(df):
    return {r[0]: None if r[1] is None else float(r[1]).hex() for r in df.collect()}


@pytest.mark.parametrize("kind", ["money", "wide", "tiny", "huge", "odd"])
def test_sums_have_equal_bits_in_any_order(spark, kind):
    rng = random.Random(kind)
    value = {"money": lambda: round(rng.uniform(-1e5, 1e5), 2), "wide": lambda: rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randrange(-40, 60)),
             "tiny": lambda: math.ldexp(rng.random(), -700), "huge": lambda: math.ldexp(rng.random() - 0.5, 1000),
             "odd": lambda: rng.choice([None, float("nan"), float("inf"), 0.0, -0.0, 1e300, 1e-300, 3.25])}[kind]
    rows = [(i % 3, value()) for i in range(3000)] + [(7, None), (8, 0.1), (9, float("-inf")), (9, float("inf"))]
    results = []
    for parts in (1, 32):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
        results.append(bits(series.stable_sum(df, ["k"], "v")))
    assert results[0] == results[1]
    assert results[0][7] is None and results[0][8] == (0.1).hex() and math.isnan(float.fromhex(results[0][9]))
    if kind != "odd":
        for k in range(3):
            exact = float(sum(Fraction(v) for g, v in rows if g == k))
            assert math.isclose(float.fromhex(results[0][k]), exact, rel_tol=1e-14)


def test_the_grid_reaches_every_bit():
    assert len(series.limb_grid(0.01, 1e6)) == 2 and series.limb_grid(None, None) == [1.0] and len(series.limb_grid(5e-324, 1.7e308)) == 42
    for least, most in ((5e-324, 5e-324), (1e-310, 1e300), (1.0, 1.0), (0.1, 3.0)):
        for x in (least, most):
            rest = x
            for unit in series.limb_grid(least, most):
                limb = math.trunc(rest / unit)
                assert abs(limb) <= 2 ** 50
                rest -= limb * unit
            assert rest == 0


def test_stable_sums_of_an_empty_table_and_in_a_forecast(spark):
    assert series.stable_sum(spark.createDataFrame([], "k int, v double"), ["k"], "v").count() == 0
    rows = [("s", dt.datetime(2024, 1, 1 + i % 3), 0.1 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "`a b` string, when timestamp_ntz, v double")
    got = series.resample(df, replace(CFG, stable_sums=True, segment_bins=2))
    assert [round(r.v, 9) for r in got.orderBy("when").collect()] == [round(sum(0.1 * i for i in range(40) if i % 3 == d), 9) for d in range(3)]


# --- J4 -------------------------------------------------------------------------------------------

def sides(spark):
    rng = random.Random(1)
    w = [(rng.choice(["hot", "HOT", "a", "b", None, "É"]), i) for i in range(60)] + [("only w", 1), ("hot", 1), ("hot", 1)]
    a = [(rng.choice(["Hot", "hot", "B", "a", None, "e"]), i) for i in range(60)] + [("only a", 1), ("hot", 1), ("hot", 1)]
    return (spark.createDataFrame(w, "wms_key string, w int"), spark.createDataFrame(a, "ax_key string, a int")), (set(w), set(a))


def expected(w, a, norm):
    out = Counter()
    for k, x in w:
        met = [(k2, y) for k2, y in a if k is not None and k2 is not None and norm(k) == norm(k2)]
        out.update((k, x, *m) for m in met or [(None, None)])
    keys = {norm(k) for k, _ in w if k is not None}
    out.update((None, None, k, y) for k, y in a if k is None or norm(k) not in keys)
    return out


@pytest.mark.parametrize("rule, norm", [("exact", str), ("lower", str.lower), ("UNICODE_CI_AI", lambda s: s.lower().replace("é", "e"))])
@pytest.mark.parametrize("split", [None, 1, 4, 1000])
def test_reconcile_by_key_rule_and_with_cut_keys(spark, rule, norm, split):
    (w, a), (w_rows, a_rows) = sides(spark)
    got = Counter(tuple(r) for r in recon.reconcile(w, a, rule=rule, split_rows=split).collect())
    assert got == expected(w_rows, a_rows, norm)


def test_a_hot_key_spreads_over_tasks(spark):
    w = spark.range(3000).select(F.lit("k").alias("wms_key"), F.col("id").alias("w"))
    a = spark.range(900).select(F.lit("k").alias("ax_key"), F.col("id").alias("a"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = [r["count"] for r in recon.reconcile(w, a, split_rows=100).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 2_700_000 and len(sizes) >= 6 and max(sizes) < 900_000


def test_a_hot_key_spreads_over_tasks_unasked(spark):
    w = spark.range(100_000).select(F.lit("k").alias("wms_key"), F.col("id").alias("w"))
    a = spark.range(7).select(F.lit("K").alias("ax_key"), F.col("id").alias("a"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = [r["count"] for r in recon.reconcile(w, a, rule="lower").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 700_000 and len(sizes) >= 2 and max(sizes) < 700_000


def without_aqe(spark, run):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pairs_are_made_above_the_joins(spark):
    w = spark.range(300).select(F.lit("k").alias("wms_key"), F.col("id").alias("w"))
    a = spark.range(200).select(F.lit("k").alias("ax_key"), F.col("id").alias("a"))
    plan = without_aqe(spark, lambda: recon.reconcile(w, a)._jdf.queryExecution().executedPlan().toString())
    assert "Generate inline(_rows" in plan and "Union" not in plan


def test_parts_of_a_large_key_grow(spark, monkeypatch):
    w = spark.range(2000).select(F.lit("k").alias("_k"), F.col("id").alias("w"))
    a = spark.range(1000).select(F.lit("k").alias("_k"), F.col("id").alias("a"))
    for side, n in zip(recon._split_hot(w, a, 1), (2000, 1000)):
        copies = [r["count"] for r in side.groupBy(side.columns[1]).count().collect()]
        assert len(copies) == n and max(copies) <= 100
    monkeypatch.setattr(recon, "LARGEST_PART", 5)
    assert recon._split_hot(w, a, 1)[1].select("_i").distinct().count() == 400


def test_rows_without_a_match_spread_over_tasks(spark):
    half = F.when(F.col("id") < 3000, F.lit("only w"))
    w = spark.range(6000).select(half.alias("wms_key"), F.col("id").alias("w"))
    a = spark.range(6000).select(F.regexp_replace(half, "w", "a").alias("ax_key"), F.col("id").alias("a"))
    sizes = without_aqe(spark, lambda: [r["count"] for r in recon.reconcile(w, a, split_rows=100).groupBy(F.spark_partition_id()).count().collect()])
    assert sum(sizes) == 12_000 and max(sizes) < 3000


def test_sums_by_kind_of_match(spark):
    from ledgerspark.plans import q_scale

    rng = random.Random(2)
    rows = [(hot, rng.choice([None, *range(5000)]) if w else None, rng.choice([None, *range(5000)]) if a else None)
            for hot in (True, False, None) for w in (0, 1) for a in (0, 1) for _ in range(40)] + [(True, None, 5), (False, 7, None)]
    expected = {}
    for hot, w, a in rows:
        e = expected.setdefault(("-" if w is None else "w") + ("-" if a is None else "a") + (" hot" if hot else ""), [0, [], [], []])
        e[0] += 1
        for i, x in ((1, w), (2, a), (3, None if w is None or a is None else w % 1009 * (a % 1013))):
            e[i] += [] if x is None else [x]
    expected = {k: (n, *[sum(x) if x else None for x in v]) for k, (n, *v) in expected.items()}
    assert len(expected) == 8
    df = spark.createDataFrame(rows, "w_hot boolean, w_order long, a_order long")
    assert {r[0]: tuple(r)[1:] for r in q_scale._summed(df).collect()} == expected
    assert q_scale._summed(df.filter("w_hot is null and w_order is null and a_order is null")).count() == 1 and q_scale._summed(df.limit(0)).count() == 0
    plan = without_aqe(spark, lambda: q_scale._summed(df)._jdf.queryExecution().executedPlan().toString())
    assert "HashAggregate(keys=[], functions=[partial_count(" in plan


# --- L2 -------------------------------------------------------------------------------------------

def test_batches_are_padded_to_their_own_longest_row(spark):
    texts = spark.createDataFrame([(i, " ".join(["w"] * n)) for i, n in enumerate([1, 5, 2, 0, 3, 1, 200])], "id int, text string")
    vocab = textprep.build_vocabulary(texts, "id")
    out = {r.id: r for r in textprep.tokenize(texts, vocab, "id", batch_rows=2).collect()}
    assert [out[i].batch for i in range(7)] == [0, 0, 1, 1, 2, 2, 3]
    assert [len(out[i].input_ids) for i in range(7)] == [5, 5, 2, 2, 3, 3, 128]
    assert [sum(out[i].attention_mask) for i in range(7)] == [1, 5, 2, 0, 3, 1, 128]
    assert out[3].input_ids == [1, 1] and out[3].labels == out[3].input_ids
    assert textprep.tokenize(texts.limit(0), vocab, "id", batch_rows=2).count() == 0


def test_positions_are_dense(spark):
    df = spark.createDataFrame([(i * 7 % 100, "x") for i in range(100)], "k int, x string").repartition(9)
    assert sorted((r.k, r.position) for r in textprep.dense_positions(df, "k").collect()) == [(i, i) for i in range(100)]


# --- M2 -------------------------------------------------------------------------------------------

def smooth(y, a, b, c):
    level, trend, season, sse = sum(y[:12]) / 12, 0.0, [x - sum(y[:12]) / 12 for x in y[:12]], 0.0
    for i, x in enumerate(y[12:]):
        s = season[i % 12]
        sse += (x - level - trend - s) ** 2
        now = a * (x - s) + (1 - a) * (level + trend)
        season[i % 12], trend, level = c * (x - now) + (1 - c) * s, b * (now - level) + (1 - b) * trend, now
    return sse


def made(a, n=400, seed=0):
    """A series whose level follows its own errors with weight ``a`` and whose trend and season stay: the best alpha is near it."""
    rng = np.random.default_rng(seed)
    level, season, y = 100.0, [10 * math.sin(i) for i in range(12)], []
    y += [level + s for s in season]
    for i in range(n):
        e = rng.normal()
        y.append(level + season[i % 12] + e)
        level += a * e
    return np.array(y)


@pytest.mark.parametrize("alpha", [0.02, 0.98])
def test_the_box_finds_optima_outside_the_grid(alpha):
    y = made(alpha)
    grid = np.array([(a, b, c) for a in CFG.smoothing_grid for b in CFG.smoothing_grid for c in CFG.smoothing_grid])
    coarse, fine = holt_winters.refine(y, grid, 0), holt_winters.refine(y, grid, 7)
    assert abs(fine[4] - alpha) < 0.05 < abs(coarse[4] - alpha)
    sse = [holt_winters.refine(y, grid, r)[3] for r in range(8)]
    assert all(x >= z for x, z in zip(sse, sse[1:]))
    assert math.isclose(fine[3], smooth(y.tolist(), *fine[4:]), rel_tol=1e-9)


def test_rounds_and_grid_reach_the_models(spark):
    rows = [("s", dt.datetime(2000 + i // 12, 1 + i % 12, 1), float(v)) for i, v in enumerate(made(0.02, 60))]
    df = spark.createDataFrame(rows, "`a b` string, when timestamp_ntz, v double")
    cfg = replace(CFG, freq="MS", min_history=24)
    fits = [holt_winters.fit_states(series.prepare(df, c), c).first() for c in (cfg, replace(cfg, smoothing_rounds=5), replace(cfg, smoothing_grid=(0.02,)))]
    assert fits[1].sse < fits[0].sse and (fits[2].alpha, fits[2].beta, fits[2].gamma) == (0.02, 0.02, 0.02)
    assert runner.run_models(series.prepare(df, cfg), replace(cfg, smoothing_rounds=2), ["Holt-Winters"]).count() == 12
    for bad in ({"smoothing_rounds": -1}, {"smoothing_grid": ()}, {"smoothing_grid": (2.0,)}, {"segment_bins": 0}):
        with pytest.raises(ValueError):
            replace(cfg, **bad)


# --- P12 ------------------------------------------------------------------------------------------

def test_money_is_rounded_once(spark):
    cases = {0.12499999999: 0.12, 0.125: 0.13, -0.125: -0.13, 2.675: 2.68, 1e28: 1e28, -1e300: -1e300, 1e-300: 0.0, 0.004999999999999: 0.0}
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    assert {r.x: r.y for r in df.withColumn("y", round_money("x")).collect()} == cases
    odd = spark.createDataFrame([(None,), (float("inf"),)], "x double").withColumn("y", round_money("x")).collect()
    assert [r.y for r in odd] == [None, float("inf")]


# --- R1, S5: the wide sheet ---------------------------------------------------------------------

def test_wide_sheet_is_dealt_by_part_in_tasks_of_bounded_rows(spark, tmp_dir, monkeypatch):
    from ledgerspark.plans import q_series

    lines = [(p, dt.datetime(2020 + m // 12, m % 12 + 1, 3), float(p + m)) for p in range(1, 31) for m in range(p % 5, 20, 3)]
    lines += [(7, None, 2.0), (7, None, 3.0), (None, dt.datetime(2020, 1, 1), 9.0), (8, dt.datetime(2020, 1, 5), None), (99, dt.datetime(2020, 1, 5), 1.0)]
    spark.createDataFrame(lines, "l_partkey long, l_shipdate timestamp, l_quantity double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    parts = [(p, "n", f"b{p}", "t", 1, 1.0) for p in [*range(1, 31), 31, 7, None]]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_dir}/part.parquet")

    monkeypatch.setattr(q_series, "ROWS_A_TASK", 10)
    sheet = q_series.wide_sales_sheet(spark, tmp_dir)
    plan = sheet._jdf.queryExecution().optimizedPlan().toString()
    assert "pivotfirst" not in plan and "RepartitionByExpression [l_partkey#" in plan and f"], {-(-len(lines) // 10)}" in plan

    cells = Counter()
    for p, d, q in lines:
        if q is not None:
            cells[p, d.strftime("%Y-%m-01") if d else "null"] += q
    names = ["null", *sorted({d.strftime("%Y-%m-01") for _, d, _ in lines if d})]
    assert sheet.columns[9:] == names
    got = Counter((r.p_partkey, *[r[n] for n in names]) for r in sheet.collect())
    assert got == Counter((p[0], *[cells.get((p[0], n)) if p[0] is not None else None for n in names]) for p in parts)
