"""Forecast models: synthetic recovery, beating a mean forecast, determinism."""

import datetime as dt

import numpy as np
import pytest

from ledgerspark.config import SeriesConfig
from ledgerspark.models import fits, runner
from ledgerspark.operators import series

CFG = SeriesConfig("sku", "d", "v", "MS", min_history=24, test_size=12)


def _frame(spark, ys: dict):
    rows = []
    for k, y in ys.items():
        for i, v in enumerate(y):
            rows.append((k, dt.datetime(2015 + i // 12, i % 12 + 1, 1), float(v)))
    return spark.createDataFrame(rows, "sku string, d timestamp_ntz, v double")


def _season(n, noise=0.0, seed=0):
    t = np.arange(n)
    rng = np.random.default_rng(seed)
    return 100 + 0.8 * t + 15 * np.sin(2 * np.pi * t / 12) + 5 * np.cos(4 * np.pi * t / 12) + noise * rng.normal(size=n)


def test_arima_recovers_exact_ar5():
    coef = np.array([0.3, -0.2, 0.15, 0.1, -0.05])
    z = [1.0, -0.5, 0.8, 0.2, -1.1]
    for _ in range(60):
        z.append(float(np.dot(coef, z[::-1][:5])))
    y = np.cumsum([50.0] + z)
    n_train = len(y) - 12
    pred = fits.arima_510(y[:n_train], 12)
    assert np.allclose(pred, y[n_train:], atol=1e-6)


def test_arima_singular_raises():
    with pytest.raises(ValueError):
        fits.arima_510(np.arange(30, dtype=float), 5)  # constant differences -> rank 1


def test_models_beat_the_mean_forecast(spark):
    y = _season(84, noise=2.0, seed=3)
    res = runner.backtest(_frame(spark, {"s": y}), CFG)
    scores = {r.Model: r.RMSE for r in res["forecast_error"].collect()}
    test = y[-12:]
    mean_rmse = float(np.sqrt(np.mean((test - y[:-12].mean()) ** 2)))
    assert set(scores) == set(runner.MODEL_NAMES)
    for m, rmse in scores.items():
        assert rmse < mean_rmse, (m, rmse, mean_rmse)
    assert scores["Holt-Winters"] < 0.25 * mean_rmse
    assert res["train"].count() == 6 * 72 and res["test"].count() == 6 * 12
    assert res["errors"].count() == 0


def test_short_series_give_error_rows_not_failures(spark):
    y = _season(30)  # train 18: enough for ARIMA, Prophet, MLP, LSTM; too short for HW (24) and SARIMA (27)
    res = runner.backtest(_frame(spark, {"short": y, "long": _season(84)}), CFG)
    errs = {(r.sku, r.Model) for r in res["errors"].collect()}
    assert errs == {("short", "Holt-Winters"), ("short", "SARIMA")}
    fc = {(r.sku, r.Model) for r in res["forecast"].select("sku", "Model").distinct().collect()}
    assert ("long", "SARIMA") in fc and ("short", "ARIMA") in fc


def test_same_answer_on_one_and_many_partitions(spark):
    df = _frame(spark, {f"s{i}": _season(60, noise=1.0, seed=i) for i in range(5)})
    prep = series.prepare(df, CFG)
    models = ["Holt-Winters", "ARIMA", "MLPRegressor"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = sorted(tuple(r) for r in runner.run_models(prep, CFG, models).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    many = sorted(tuple(r) for r in runner.run_models(prep, CFG, models).collect())
    assert len(one) == len(many) == 5 * 3 * 12
    for a, b in zip(one, many):
        assert a[:2] == b[:2] and a[3] == b[3] and abs(a[2] - b[2]) < 1e-9


def test_holt_winters_native_matches_numpy_recursion(spark):
    from ledgerspark.models import holt_winters as hw
    y = _season(48, noise=1.0, seed=7)
    prep = series.prepare(_frame(spark, {"s": y}), CFG)
    st = hw.fit_states(prep, CFG).first()
    train = y[:-12]
    a, b, c = st.alpha, st.beta, st.gamma
    lvl = float(np.sum(train[:12])) / 12
    trend, season, sse = 0.0, list(train[:12] - lvl), 0.0
    for x in train[12:]:
        s0 = season[0]
        new_l = a * (x - s0) + (1 - a) * (lvl + trend)
        sse += (x - (lvl + trend + s0)) ** 2
        trend = b * (new_l - lvl) + (1 - b) * trend
        season = season[1:] + [c * (x - new_l) + (1 - c) * s0]
        lvl = new_l
    assert abs(st.level - lvl) < 1e-9 and abs(st.sse - sse) < 1e-6


def test_native_arima_matches_least_squares(spark):
    from ledgerspark.models import arima
    coef = np.array([0.3, -0.2, 0.15, 0.1, -0.05])
    z = [1.0, -0.5, 0.8, 0.2, -1.1]
    for _ in range(60):
        z.append(float(np.dot(coef, z[::-1][:5])))
    exact = np.cumsum([50.0] + z)
    noisy = _season(70, noise=3.0, seed=11)
    prep = series.prepare(_frame(spark, {"exact": exact, "noisy": noisy, "flat": np.full(40, 5.0)}), CFG)
    out = {}
    for r in arima.forecast(prep, CFG).collect():
        out.setdefault(r.sku, []).append(r)
    got = np.array([r.v for r in sorted(out["exact"], key=lambda r: r.d)])
    assert np.allclose(got, exact[-12:], atol=1e-6)
    ref = fits.arima_510(noisy[:-12], 12)
    got = np.array([r.v for r in sorted(out["noisy"], key=lambda r: r.d)])
    assert np.allclose(got, ref, rtol=1e-6, atol=1e-6)
    assert [r.error for r in out["flat"]] == ["singular ARIMA system"]
