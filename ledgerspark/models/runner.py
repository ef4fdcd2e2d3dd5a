"""Fit every series with every model and assemble the four
result tables (forecast, forecast_error, train, test).

One shuffle on the dimension feeds the grouped maps; a group is one series
already reduced to its periods by ``series.prepare`` (so a dimension value
that owns a third of the raw rows is still only a few hundred periods here).
A failing series returns an error row and never fails the stage.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.config import SeriesConfig
from ledgerspark.models import arima, fits, holt_winters
from ledgerspark.operators import metrics, series, validate
from ledgerspark.operators.series import IDX, N_PERIODS, SPLIT
from ledgerspark.session import ensure_checkpoint_dir, ship_package

MODEL_NAMES = ("Prophet", "Holt-Winters", "SARIMA", "ARIMA", "MLPRegressor", "LSTM")
SERIES_MODELS = ("Prophet", "SARIMA")
WINDOW_MODELS = ("MLPRegressor", "LSTM")
BASE_SEED = 42


def _schema(prepared: DataFrame, cfg: SeriesConfig) -> T.StructType:
    dim_field = prepared.schema[cfg.dimension_col]
    return T.StructType([
        T.StructField(cfg.dimension_col, dim_field.dataType, True),
        T.StructField(cfg.date_col, T.TimestampNTZType(), True),
        T.StructField(cfg.value_col, T.DoubleType(), True),
        T.StructField("Model", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ])


def _seed(key) -> int:
    return (BASE_SEED + zlib.crc32(str(key).encode())) % (2 ** 32)


def _rows(key, dates, values, model, error, cfg):
    return pd.DataFrame({cfg.dimension_col: [key] * len(dates), cfg.date_col: dates,
                         cfg.value_col: values, "Model": model, "error": error})


def _spread(df: DataFrame, dim: str) -> DataFrame:
    """Range-partition by series into ``spark.sql.shuffle.partitions`` parts.

    Per-series stages (windows, grouped model fits) are compute-heavy on
    little data, so AQE would fold them into one task; it never coalesces a
    repartition by number. Range (not hash) partitioning is used because a
    hash repartition matching the upstream shuffle is dropped as redundant,
    and because sorted key ranges spread series evenly over the slots. The
    operators after it reuse this partitioning (no second shuffle)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, dim)


def _future(last, h, freq):
    return pd.date_range(start=pd.Timestamp(last) + pd.tseries.frequencies.to_offset(freq), periods=h, freq=freq)


def fit_series_models(prepared: DataFrame, cfg: SeriesConfig, models=SERIES_MODELS) -> DataFrame:
    """M1, M3: one grouped map over the training periods of each series."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    h, freq, names = cfg.horizon, cfg.freq, tuple(models)
    train = prepared.filter(F.col(SPLIT) == "train").select(dim, date, F.col(val).cast("double").alias(val), IDX)

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(IDX)
        key = pdf[dim].iloc[0]
        y = pdf[val].to_numpy(dtype=float)
        ds = pdf[date].to_numpy(dtype="datetime64[ns]")
        fut = _future(ds[-1], h, freq)
        out = []
        for name in names:
            try:
                if len(y) < fits.MIN_TRAIN[name]:
                    raise ValueError(f"train has {len(y)} periods; {name} needs {fits.MIN_TRAIN[name]}")
                if name == "Prophet":
                    pred = fits.prophet_like(y, ds, fut.to_numpy(dtype="datetime64[ns]"))
                else:
                    pred = fits.sarima_111_111(y, h)
                if not np.all(np.isfinite(pred)):
                    raise ValueError("non-finite forecast")
                out.append(_rows(key, fut, pred, name, None, cfg))
            except Exception as e:  # noqa: BLE001 -- one failing series is reported, not fatal
                out.append(_rows(key, [ds[-1]], [None], name, f"{type(e).__name__}: {e}", cfg))
        return pd.concat(out, ignore_index=True)

    ship_package(prepared.sparkSession)
    return _spread(train, dim).groupBy(dim).applyInPandas(per_series, _schema(prepared, cfg))


def fit_window_model(prepared: DataFrame, cfg: SeriesConfig, model: str) -> DataFrame:
    """M5 (unscaled) and M6 (min-max scaled): Spark builds the supervised
    windows (T4) and the scaling (T5); the grouped map only trains and runs
    the recursion from the last window."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    w, h, freq = cfg.window_size, cfg.horizon, cfg.freq
    # one exchange by series (explicit count: AQE keeps it) serves the scaling
    # window, the lag windows and the grouped map
    train = _spread(prepared.filter(F.col(SPLIT) == "train"), dim)
    if model == "LSTM":
        train = series.minmax_scale(train, cfg, fit_on=None).withColumn("_v", F.col("scaled"))
    else:
        train = train.withColumn("_v", F.col(val).cast("double")).withColumn("_min", F.lit(0.0)) \
            .withColumn("_max", F.lit(1.0))
    spec = Window.partitionBy(dim).orderBy(IDX)
    last_idx = F.col(N_PERIODS) - F.lit(cfg.test_size if cfg.test_mode else 0) - 1
    t = (train.withColumn("X", F.collect_list("_v").over(spec.rowsBetween(-w, -1)))
         .withColumn("S", F.collect_list("_v").over(spec.rowsBetween(-w + 1, 0)))
         .withColumn("is_seed", F.col(IDX) == last_idx))
    t = t.filter((F.size("X") == w) | F.col("is_seed")).select(
        dim, date, "X", F.col("_v").alias("y"), F.when(F.col("is_seed"), F.col("S")).alias("S"),
        "is_seed", "_min", "_max", F.col(N_PERIODS))

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf[dim].iloc[0]
        seed_row = pdf[pdf["is_seed"]].iloc[0]
        last = seed_row[date]
        fut = _future(last, h, freq)
        rows = pdf[pdf["X"].map(len) == w]
        n_train = len(rows) + w
        try:
            if len(seed_row["S"]) < w or n_train < fits.MIN_TRAIN[model]:
                raise ValueError(f"train too short for {model} (window {w})")
            X = np.stack(rows["X"].to_numpy()).astype(float)
            y = rows["y"].to_numpy(dtype=float)
            S = np.asarray(seed_row["S"], dtype=float)
            fit = fits.lstm_fit_predict if model == "LSTM" else fits.mlp_fit_predict
            pred = fit(X, y, S, h, _seed(key))
            pred = pred * (seed_row["_max"] - seed_row["_min"]) + seed_row["_min"] if model == "LSTM" else pred
            if not np.all(np.isfinite(pred)):
                raise ValueError("non-finite forecast")
            return _rows(key, fut, pred, model, None, cfg)
        except Exception as e:  # noqa: BLE001
            return _rows(key, [last], [None], model, f"{type(e).__name__}: {e}", cfg)

    ship_package(prepared.sparkSession)
    return t.groupBy(dim).applyInPandas(per_series, _schema(prepared, cfg))


def run_models(prepared: DataFrame, cfg: SeriesConfig, models=MODEL_NAMES) -> DataFrame:
    """Union of every requested model's output rows (dim, date, value, Model, error)."""
    outs = []
    if "Holt-Winters" in models:
        hw = holt_winters.forecast(prepared, cfg)
        outs.append(hw.select(cfg.dimension_col, cfg.date_col, F.col(cfg.value_col).cast("double"), "Model", "error"))
    if "ARIMA" in models:
        ar = arima.forecast(prepared, cfg)
        outs.append(ar.select(cfg.dimension_col, cfg.date_col, F.col(cfg.value_col).cast("double"), "Model", "error"))
    sm = [m for m in models if m in SERIES_MODELS]
    if sm:
        outs.append(fit_series_models(prepared, cfg, sm))
    for m in WINDOW_MODELS:
        if m in models:
            outs.append(fit_window_model(prepared, cfg, m))
    return reduce(DataFrame.unionByName, outs)


def backtest(df_long: DataFrame, cfg: SeriesConfig, models=MODEL_NAMES,
             materialize: bool = False) -> dict[str, DataFrame]:
    """M7 + T11: the four result tables and the per-series failures.

    ``forecast``: date, value, dimension, Model. ``forecast_error``: Model,
    dimension, RMSE, MAE, ``MAPE (%)`` (cleaned as R5; test mode only).
    ``train`` / ``test``: date, value, dimension, Model for each model that
    produced a forecast for the series. ``errors``: dimension, Model, error.

    ``materialize``: when the tables feed several actions (one load per
    table), write the prepared series and the model output once to the
    shared checkpoint folder (reliable ``checkpoint``), so no model is
    refitted per table and a lost executor re-reads instead of recomputing.
    """
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    prepared = series.prepare(df_long, cfg)
    if materialize:
        ensure_checkpoint_dir(prepared.sparkSession)
        prepared = prepared.checkpoint(eager=True)
    out = run_models(prepared, cfg, models)
    if materialize:
        out = out.checkpoint(eager=True)
    forecast = out.filter(F.col("error").isNull()).select(date, val, dim, "Model")
    errors = out.filter(F.col("error").isNotNull()).select(dim, "Model", "error")
    fitted = forecast.select(dim, "Model").distinct()
    base = prepared.select(date, F.col(val).cast("double").alias(val), dim, SPLIT)
    train = base.filter(F.col(SPLIT) == "train").join(fitted, dim).select(date, val, dim, "Model")
    result = {"forecast": forecast, "train": train, "errors": errors}
    if cfg.test_mode:
        test = base.filter(F.col(SPLIT) == "test").join(fitted, dim).select(date, val, dim, "Model")
        # scored straight from the hold-out rows: no model is fitted a second time to find who has a forecast
        actual = base.filter(F.col(SPLIT) == "test").select(dim, date, F.col(f"`{val}`").alias("actual"))
        pairs = actual.join(forecast.withColumnRenamed(val, "predicted"), [dim, date], "inner")
        scored = metrics.score(pairs, ["Model", dim])
        result["test"] = test
        result["forecast_error"] = validate.clean_metrics(scored).select("Model", dim, "RMSE", "MAE", "MAPE (%)")
    return result


def forecast_and_load(raw_long: DataFrame, cfg: SeriesConfig, script_name: str, target,
                      models=MODEL_NAMES) -> dict[str, int]:
    """D11-D13 tail: validate (R4), run every model (M7) and load the clean source, the rejected rows, forecast, forecast_error,
    train, test and errors (K1, replaced). The raw rows are read and parsed once. A target that can ``publish`` shows all these
    tables at once, so forecasts never stand beside another run's source. Returns table -> rows written."""
    from ledgerspark.sinks.tables import upload
    clean, rejected, _members = validate.validate_split(raw_long, cfg, materialize=True)
    res = backtest(clean, cfg, models, materialize=True)
    tables = {k: res[k] for k in ("forecast", "forecast_error", "train", "test", "errors") if k in res}
    return upload({"source": clean, "rejected_data": rejected, **tables}, script_name, target)
