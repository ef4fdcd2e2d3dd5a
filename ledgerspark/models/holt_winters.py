"""M2: additive Holt-Winters (trend + season 12).

Each training series becomes one row with its sorted values (bounded by its
number of periods). The smoothing grid is searched in Arrow batches of such
rows: one loop over the periods advances all grid points at once as NumPy
vectors; the least-SSE point is kept. Preparation, assembly and scoring stay
DataFrame operations.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.config import SeriesConfig
from ledgerspark.operators.series import SPLIT
from ledgerspark.session import ship_package

MODEL = "Holt-Winters"
SEASON = 12
# Half the distance of the default grid's values: the first box around the best grid point.
BOX = 0.1
MIN_TRAIN = 2 * SEASON
STATE = ("level", "trend", "season", "sse", "alpha", "beta", "gamma")


def search(y: np.ndarray, grid: np.ndarray):
    """(level, trend, season, sse, alpha, beta, gamma) of the first least-SSE row of ``grid`` (alpha, beta, gamma)."""
    a, b, c = grid.T
    level = np.full(len(grid), sum(y[:SEASON].tolist()) / SEASON)
    trend, sse = np.zeros(len(grid)), np.zeros(len(grid))
    season = y[:SEASON, None] - level  # row i % SEASON is replaced in place
    rest = y[SEASON:]
    for i, x in enumerate(rest.tolist()):
        s0, ahead = season[i % SEASON], level + trend
        now = a * (x - s0) + (1 - a) * ahead
        err = x - (ahead + s0)
        trend = b * (now - level) + (1 - b) * trend
        season[i % SEASON] = c * (x - now) + (1 - c) * s0
        level, sse = now, sse + err * err
    k = int(np.argmin(np.where(np.isnan(sse), np.inf, sse)))
    order = (len(rest) + np.arange(SEASON)) % SEASON
    return level[k], trend[k], season[order, k], sse[k], *grid[k]


def refine(y: np.ndarray, grid: np.ndarray, rounds: int):
    """``search`` over ``grid``, then ``rounds`` times over the 27 points one step away from the best one or on it, the step halved each
    time from ``BOX`` and parameters kept within 0 and 1. The best point is among the next round's, so the SSE never rises."""
    best = search(y, grid)
    step = BOX
    for _ in range(rounds):
        near = [sorted({min(max(p + d, 0.0), 1.0) for d in (-step, 0.0, step)}) for p in best[4:]]
        best = search(y, np.array(list(itertools.product(*near)), float))
        step /= 2
    return best


def fit_states(prepared: DataFrame, cfg: SeriesConfig, grid=None) -> DataFrame:
    """Best final state per series: dim, last_date, n_train, level, trend, season, sse, alpha, beta, gamma.

    One row per series throughout; the winner is the first minimum SSE (grid
    in ascending (a, b, c) order, so ties go to the smallest triple)."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    n_parts = int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the grid search is compute-heavy per row: an explicit range repartition keeps
    # AQE from folding the series into one task (see runner._spread)
    train = prepared.filter(F.col(SPLIT) == "train").repartitionByRange(n_parts, dim)
    arr = train.groupBy(dim).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("period_idx", F.col(val).cast("double").alias("v")))),
                    lambda s: s["v"]).alias("y"),
        F.max(date).alias("last_date"))
    ok = arr.withColumn("n_train", F.size("y")).filter(F.col("n_train") >= MIN_TRAIN)
    points = np.array(list(itertools.product(grid or cfg.smoothing_grid, repeat=3)), float)
    rounds = cfg.smoothing_rounds

    def fit(batches):
        for pdf in batches:
            found = [refine(np.asarray(y, float), points, rounds) for y in pdf["y"]]
            yield pd.concat([pdf.drop(columns="y"), pd.DataFrame(found, columns=list(STATE), index=pdf.index)], axis=1)

    rows = ok.select(dim, "last_date", "n_train", "y")
    state = [T.StructField(n, T.ArrayType(T.DoubleType()) if n == "season" else T.DoubleType()) for n in STATE]
    ship_package(prepared.sparkSession)
    return rows.mapInPandas(fit, T.StructType([f for f in rows.schema if f.name != "y"] + state))


def forecast(prepared: DataFrame, cfg: SeriesConfig, grid=None) -> DataFrame:
    """Forecast rows (dim, date, value, Model, error) plus one error row per
    series too short to fit."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    h = cfg.horizon
    st = fit_states(prepared, cfg, grid)
    k = F.col("k")
    pred = F.col("level") + k * F.col("trend") + F.element_at("season", ((k - 1) % SEASON + 1).cast("int"))
    rows = st.select(dim, "last_date", "level", "trend", "season",
                     F.explode(F.sequence(F.lit(1), F.lit(h))).alias("k"))
    out = rows.select(dim, (F.col("last_date") + F.expr(cfg.step) * k).alias(date), pred.alias(val),
                      F.lit(MODEL).alias("Model"), F.lit(None).cast("string").alias("error"))
    train = prepared.filter(F.col(SPLIT) == "train")
    short = (train.groupBy(dim).agg(F.count(F.lit(1)).alias("n"), F.max(date).alias(date))
             .filter(F.col("n") < MIN_TRAIN)
             .select(dim, F.col(date), F.lit(None).cast("double").alias(val), F.lit(MODEL).alias("Model"),
                     F.format_string(f"train has %d periods; {MODEL} needs {MIN_TRAIN}", F.col("n")).alias("error")))
    return out.unionByName(short)
