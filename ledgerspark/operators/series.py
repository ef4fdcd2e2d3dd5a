"""Resampling, history filter, hold-out split, supervised windows,
scaling, future axis and recursive forecasts -- for all series at once.

Every series lives in one DataFrame keyed by the dimension. Rows are reduced to
(series, period) by a partial (map-side) aggregation before anything is keyed
by series alone, so a series that owns a third of the raw rows costs no more
than its number of periods downstream.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.dates import bin_number, bin_of_number, bin_start

SPLIT = "split"
IDX = "period_idx"
N_PERIODS = "n_periods"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


LIMB_BITS = 50  # a limb and its product with a power of two are exact in a DOUBLE


def limb_grid(least: float | None, most: float | None) -> list[float]:
    """Powers of two, ``LIMB_BITS`` apart, whose integer multiples sum up to any DOUBLE between ``least`` and ``most`` in size: from the
    top bit of the largest to the last bit of the smallest. Two or three for amounts, 42 for all DOUBLEs there are."""
    if not most:
        return [1.0]
    top, last = math.frexp(most)[1], max(math.frexp(least)[1] - 53, -1074)
    units = range(top - LIMB_BITS, last - LIMB_BITS, -LIMB_BITS)
    return [math.ldexp(1.0, max(u, -1074)) for u in units] or [math.ldexp(1.0, last)]


def stable_sum(df: DataFrame, keys, col: str) -> DataFrame:
    """``df.groupBy(keys).agg(sum(col))`` of a DOUBLE column, with equal bits for any order of rows and any number of partitions.

    Every value is cut into integers of ``LIMB_BITS`` bits on one grid for the whole column, without loss; the grid follows from
    the largest and smallest size in it (one pass over the column, two numbers on the driver). Integers are summed
    exactly, as decimals and map side first, and the limbs are put together at the end, smallest first. Non-finite values act
    as in SUM."""
    v = _q(col).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    size = F.when(finite & (v != 0), F.abs(v))
    ends = df.agg(F.min(size).alias("least"), F.max(size).alias("most")).first()
    grid = limb_grid(ends["least"], ends["most"])
    limbs, step = [], df.withColumn("_rest", F.when(finite, v))
    for i, unit in enumerate(grid):
        # dividing by a power of two is exact, and so is what is left
        limb = F.when(F.col("_rest") < 0, F.ceil(F.col("_rest") / unit)).otherwise(F.floor(F.col("_rest") / unit))
        step = step.withColumn(f"_limb{i}", limb.cast("long"))
        step = step.withColumn("_rest", F.col("_rest") - F.col(f"_limb{i}").cast("double") * unit)
        limbs.append(F.sum(F.col(f"_limb{i}").cast("decimal(20,0)")).alias(f"_limb{i}"))
    sums = step.groupBy(*keys).agg(*limbs, F.sum(F.when(~finite, v)).alias("_odd"))
    total = F.lit(0.0)
    for i in reversed(range(len(grid))):
        total = total + F.col(f"_limb{i}").cast("double") * grid[i]
    keep = [_q(k) for k in keys]
    return sums.select(*keep, F.when(F.col("_odd").isNull(), total).when(F.col("_limb0").isNull(), F.col("_odd")).otherwise(total + F.col("_odd")).alias(col))


def period_sums(df: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """A5: sum per (series, period bin); NULL dimension or date rows are dropped. ``cfg.stable_sums`` makes sums of DOUBLE (or
    FLOAT) values independent of the order of rows; sums of integers and decimals always are."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    rows = (df.filter(_q(dim).isNotNull() & _q(date).isNotNull())
            .select(_q(dim).alias(dim), bin_start(_q(date), cfg.freq).alias(date), _q(val).alias(val)))
    if cfg.stable_sums and isinstance(rows.schema[val].dataType, (T.DoubleType, T.FloatType)):
        return stable_sum(rows, [dim, date], val)
    return rows.groupBy(dim, date).agg(F.sum(_q(val)).alias(val))


def resample_segments(df: DataFrame, cfg: SeriesConfig, min_history: int | None = None, bins: int = 4096) -> DataFrame:
    """``resample`` in segments of ``bins`` periods, so that one series of any length spreads over many tasks.

    A period's number follows from its start, so a segment is a fixed range of numbers and a period's place in its series is its
    number less the first one: no scan over a series. Segments without any row are made from the series' first and last number
    (a row per series), and each segment fills its own gaps."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    sums = period_sums(df, cfg)
    zero = F.lit(0).cast(sums.schema[val].dataType)
    number = bin_number(_q(date), cfg.freq)
    held = (sums.select(_q(dim), number.alias("_k"), F.coalesce(_q(val), zero).alias("_v")).withColumn("_seg", F.floor(F.col("_k") / bins))
            .groupBy(dim, "_seg").agg(F.array_sort(F.collect_list(F.struct("_k", "_v"))).alias("_rows")))
    spans = (held.groupBy(dim).agg(F.min(F.col("_rows")[0]["_k"]).alias("_lo"), F.max(F.element_at("_rows", -1)["_k"]).alias("_hi"))
             .withColumn(N_PERIODS, (F.col("_hi") - F.col("_lo") + 1).cast("int")))
    if min_history:
        spans = spans.filter(F.col(N_PERIODS) >= min_history)
    axis = spans.withColumn("_seg", F.explode(F.sequence(F.floor(F.col("_lo") / bins), F.floor(F.col("_hi") / bins))))
    # dealt out by segment whichever join follows: filling the gaps is the work
    axis = axis.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _q(dim), "_seg")
    seg = axis.join(held, [dim, "_seg"], "left")
    start, stop = F.greatest("_lo", F.col("_seg") * bins), F.least("_hi", F.col("_seg") * bins + (bins - 1))
    head = F.array(F.struct(start.alias("_k"), zero.alias("_v")))
    rows = F.when(F.col("_rows").isNull(), head).when(F.col("_rows")[0]["_k"] > start, F.concat(head, "_rows")).otherwise(F.col("_rows"))
    # each row is followed by the run of empty periods up to the next one
    seg = seg.select(dim, "_lo", N_PERIODS, rows.alias("_rows"), stop.alias("_stop"))
    runs = seg.select(dim, "_lo", N_PERIODS, F.explode(F.transform("_rows", lambda r, i: F.struct(
        r["_k"].alias("_k"), r["_v"].alias("_v"), F.coalesce(F.get(F.col("_rows"), i + 1)["_k"] - 1, F.col("_stop")).alias("_to")))).alias("_run"))
    rows = runs.select(dim, "_lo", N_PERIODS, "_run._k", "_run._v", F.explode(F.sequence("_run._k", "_run._to")).alias("_n"))
    return rows.select(_q(dim), bin_of_number("_n", cfg.freq).alias(date), F.when(F.col("_n") == F.col("_k"), F.col("_v")).otherwise(zero).alias(val),
                       (F.col("_n") - F.col("_lo")).cast("int").alias(IDX), F.col(N_PERIODS))


def resample(df: DataFrame, cfg: SeriesConfig, min_history: int | None = None) -> DataFrame:
    """T1 (+T2 when ``min_history``): per series, sum by ``freq`` bin; every
    empty bin between the series' first and last bin is 0.

    Two shuffles: the partial sum per (series, bin), then one by series for
    the windows. Each bin is followed by the run of empty bins up to the
    series' next one, so the fill is linear in the periods and needs no join
    and no lookup. Short series are dropped before any row is generated (T2).

    A task holds whole series; with ``cfg.segment_bins`` it holds that many bins of one (``resample_segments``).

    Output: dimension, date, value, ``period_idx``, ``n_periods``.
    """
    if cfg.segment_bins:
        return resample_segments(df, cfg, min_history, cfg.segment_bins)
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    sums = period_sums(df, cfg)
    zero = F.lit(0).cast(sums.schema[val].dataType)
    of_series = Window.partitionBy(_q(dim))
    by_date = of_series.orderBy(_q(date))
    last = F.coalesce(F.lead(_q(date)).over(by_date) - F.expr(cfg.step), _q(date))
    runs = sums.withColumn("_run", F.sequence(_q(date), last, F.expr(cfg.step))).withColumn("_size", F.size("_run"))
    runs = (runs.withColumn("_first", F.coalesce(F.sum("_size").over(by_date.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn(N_PERIODS, F.sum("_size").over(of_series).cast("int")))
    if min_history:
        runs = runs.filter(F.col(N_PERIODS) >= min_history)
    rows = runs.select(_q(dim), _q(val), "_first", F.col(N_PERIODS), F.posexplode("_run").alias("_pos", date))
    value = F.when(F.col("_pos") == 0, F.coalesce(_q(val), zero)).otherwise(zero)
    return rows.select(_q(dim), _q(date), value.alias(val), (F.col("_first") + F.col("_pos")).cast("int").alias(IDX),
                       F.col(N_PERIODS))


def split_holdout(resampled: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """In test mode the last ``test_size`` bins are 'test', the rest 'train';
    otherwise everything is 'train'. Uses the position carried by ``resample``,
    so no window (and no extra shuffle) is needed."""
    if not cfg.test_mode:
        return resampled.withColumn(SPLIT, F.lit("train"))
    is_test = F.col(IDX) >= F.col(N_PERIODS) - F.lit(cfg.test_size)
    return resampled.withColumn(SPLIT, F.when(is_test, "test").otherwise("train"))


def prepare(df: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """T1 -> T2 -> T3 in one plan."""
    return split_holdout(resample(df, cfg, cfg.min_history), cfg)


def supervised_windows(series: DataFrame, cfg: SeriesConfig, window: int | None = None,
                       value_col: str | None = None) -> DataFrame:
    """T4: for each period with ``window`` predecessors, X = the previous
    ``window`` values (oldest first) and y = the value itself."""
    w = window or cfg.window_size
    dim, date = cfg.dimension_col, cfg.date_col
    val = value_col or cfg.value_col
    spec = Window.partitionBy(dim).orderBy(date).rowsBetween(-w, -1)
    out = series.withColumn("X", F.collect_list(_q(val).cast("double")).over(spec))
    return out.filter(F.size("X") == w).withColumn("y", _q(val).cast("double"))


def minmax_scale(series: DataFrame, cfg: SeriesConfig, fit_on: str | None = "train",
                 value_col: str | None = None) -> DataFrame:
    """T5: scale to [0, 1] with the min and max of the series' ``fit_on`` rows
    (all rows when None); a constant series scales to 0. Adds ``_min``, ``_max``
    and ``scaled``. Window aggregates over the series partition: no self-join,
    and the partitioning is reused by later per-series windows."""
    dim = cfg.dimension_col
    val = value_col or cfg.value_col
    v = _q(val).cast("double")
    basis = v if fit_on is None else F.when(F.col(SPLIT) == fit_on, v)
    per_series = Window.partitionBy(dim)
    out = series.withColumn("_min", F.min(basis).over(per_series)).withColumn("_max", F.max(basis).over(per_series))
    span = F.col("_max") - F.col("_min")
    scaled = F.coalesce(F.try_divide(v - F.col("_min"), F.when(span != 0, span)), F.lit(0.0))
    return out.withColumn("scaled", scaled)


def minmax_inverse(scaled: Column, lo: Column, hi: Column) -> Column:
    """T5 inverse: map a scaled value back to the series' units."""
    return scaled * (hi - lo) + lo


def future_axis(last_dates: DataFrame, cfg: SeriesConfig, horizon: int | None = None,
                last_col: str = "last_date") -> DataFrame:
    """For each series, the ``horizon`` bins after ``last_col`` with step
    number k = 1..horizon."""
    h = horizon or cfg.horizon
    dim, date = cfg.dimension_col, cfg.date_col
    start = F.col(last_col) + F.expr(cfg.step)
    stop = F.col(last_col) + F.expr(cfg.step) * F.lit(h)
    dates = F.sequence(start, stop, F.expr(cfg.step))
    return last_dates.select(_q(dim), F.posexplode(dates).alias("k", date)).withColumn("k", F.col("k") + 1)


def recursive_forecast(history: Column, coefs: Column, intercept: Column, horizon: int) -> Column:
    """H-step recursive forecast of a linear autoregression.

    ``history`` is the last p values (oldest first), ``coefs`` the p
    coefficients in the same order. Each prediction is pushed into the window
    before the next step. Returns ARRAY<DOUBLE> of length ``horizon``; runs as
    one higher-order ``aggregate`` in the JVM (interpreted, no Python).
    """
    init = F.struct(history.cast("array<double>").alias("w"), F.array().cast("array<double>").alias("out"))

    def step(acc, _k):
        nxt = intercept + F.aggregate(F.zip_with(coefs, acc["w"], lambda a, b: a * b), F.lit(0.0),
                                      lambda s, x: s + x)
        window = F.concat(F.slice(acc["w"], 2, F.size(acc["w"])), F.array(nxt))
        return F.struct(window.alias("w"), F.concat(acc["out"], F.array(nxt)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["out"]
