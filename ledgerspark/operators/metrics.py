"""Forecast scores per (model, series), as one partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(actual: Column, pred: Column) -> Column:
    """sqrt(mean((a - p)^2))."""
    return F.sqrt(F.avg(F.pow(actual - pred, 2)))


def mae(actual: Column, pred: Column) -> Column:
    """mean(|a - p|)."""
    return F.avg(F.abs(actual - pred))


def mape(actual: Column, pred: Column) -> Column:
    """mean(|(a - p) / a|) * 100. Any zero actual makes the reference's
    value inf or NaN, which its metric cleanup then drops: here it is NULL."""
    has_zero = F.max(F.when(actual == 0, 1).otherwise(0)) == 1
    return F.when(has_zero, F.lit(None).cast("double")).otherwise(
        F.avg(F.abs(F.try_divide(actual - pred, actual))) * 100)


def score(pairs: DataFrame, keys, actual: str = "actual", pred: str = "predicted") -> DataFrame:
    """RMSE, MAE and ``MAPE (%)`` per key group of (actual, predicted) rows."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return pairs.groupBy(*keys).agg(rmse(a, p).alias("RMSE"), mae(a, p).alias("MAE"),
                                    mape(a, p).alias("MAPE (%)"))
