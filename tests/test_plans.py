"""Plan shape of every registered query: no cartesian products, no nested-loop
joins, no row-at-a-time Python UDFs, and scans that read only needed columns."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

# Queries that write files while being built (their plans read back written data).
SIDE_EFFECT_PREFIXES = ("s4_", "s6_", "d8_", "d9_", "d10_", "d11_", "k5_", "k6_", "k8_", "k9_", "k11_")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
NAMES = sorted(n for n in entry.queries() if not n.startswith(SIDE_EFFECT_PREFIXES))


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans a {op}"
    # lineitem has 11 columns; no query needs all of them
    for line in plan.splitlines():
        scan = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        if scan and "lineitem.parquet" in line:
            assert scan.group(1).count("#") < 11, f"{name} reads every lineitem column"


@pytest.mark.parametrize("name,table", [("d6_erp_orders", "labels"), ("j2_j3_double_alias", "documents")])
def test_unused_left_join_is_removed(spark, name, table):
    """A left join whose columns are never used, under DISTINCT / GROUP BY,
    is removed by Catalyst -- the table is not even scanned."""
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f"{table}.parquet" not in plan


def test_hot_series_is_pre_aggregated_before_shuffle(spark):
    """One series owning a third of the rows: the per-(series, bin) sum runs
    map-side (partial aggregate) before the first shuffle, so no task ever
    receives that series' raw rows; totals are kept."""
    from pyspark.sql import functions as F

    from ledgerspark.config import SeriesConfig
    from ledgerspark.operators import series
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.timestamp_seconds(F.lit(1577836800) + F.col("id") * 3600).cast("timestamp_ntz").alias("d"),
        F.lit(1.0).alias("v"))
    cfg = SeriesConfig("k", "d", "v", "MS", min_history=1, test_mode=False)
    out = series.resample(df, cfg)
    plan = out._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rfind("Exchange")
    assert "partial_sum" in plan[first_exchange:], "no map-side partial sum below the first shuffle"
    totals = dict(out.groupBy("k").agg(F.sum("v")).collect())
    assert totals["hot"] == n // 3 and sum(totals.values()) == n


@pytest.mark.parametrize("name,maps", [("m2_backtest_scores_brand", 1), ("m7_backtest_forecast_error_brand", 4)])
def test_each_model_group_is_fitted_once(spark, name, maps):
    """One Python stage per model group (Holt-Winters, series models, two window models): scoring refits nothing."""
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FlatMapGroupsIn(?:Pandas|Arrow)|MapInPandas", plan)) == maps
