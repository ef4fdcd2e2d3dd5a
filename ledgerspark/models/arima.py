"""M4: ARIMA(5,1,0) by conditional least squares, fitted natively in Spark.

z = first difference of the training series; z_t is regressed on
z_(t-1) .. z_(t-5) without a constant. Per series the normal equations are
21 cross-product sums (a partial aggregation, so a long series is summed
map-side before its one row per series is shuffled). The 5x5 system is
solved in a projection with higher-order functions (Gaussian elimination;
X'X is symmetric positive semi-definite, so no pivoting is needed and a
vanishing pivot means a singular system -> error row), and the forecast is
the native recursion of ``series.recursive_forecast`` plus a running sum back
to levels. No Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.operators.series import IDX, SPLIT, recursive_forecast

MODEL = "ARIMA"
P = 5
MIN_TRAIN = 2 * P + 1
SINGULAR_TOL = 1e-10


def _solve(aug):
    """Solve the system held as an array of P rows [A | b]; NULL when singular."""
    def eliminate(m, k):
        piv = F.element_at(F.element_at(m, k + 1), k + 1)
        prow = F.element_at(m, k + 1)
        return F.transform(m, lambda row, i: F.when(i <= k, row).otherwise(
            F.transform(row, lambda v, j: v - F.try_divide(F.element_at(row, k + 1), piv) * F.element_at(prow, j + 1))))

    upper = F.aggregate(F.sequence(F.lit(0), F.lit(P - 2)), aug, eliminate)
    diag = F.transform(upper, lambda row, i: F.element_at(row, i + 1))
    scale = F.aggregate(diag, F.lit(0.0), lambda acc, d: F.greatest(acc, F.abs(d)))
    # a zero or NULL pivot (NULL: an earlier pivot was zero) means a singular system
    singular = F.coalesce(F.exists(diag, lambda d: F.coalesce(F.abs(d) <= scale * SINGULAR_TOL, F.lit(True))),
                          F.lit(True)) | F.coalesce(scale == 0, F.lit(True))

    def back(x, i):
        # x holds the solved entries i+1..P-1 (in order); prepend entry i
        row = F.element_at(upper, i + 1)
        tail = F.aggregate(F.zip_with(F.slice(row, i + 2, P - 1 - i), x, lambda a, b: a * b),
                           F.lit(0.0), lambda acc, v: acc + v)
        xi = F.try_divide(F.element_at(row, P + 1) - tail, F.element_at(row, i + 1))
        return F.concat(F.array(xi), x)

    solution = F.aggregate(F.sequence(F.lit(P - 1), F.lit(0), F.lit(-1)), F.array().cast("array<double>"), back)
    return F.when(singular, F.lit(None).cast("array<double>")).otherwise(solution)


def fit(prepared: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """Per series: coefficients (lag 1..P), the last P differences (oldest
    first), last level and last date, and the training length.

    One window pass (lags) and one aggregation that reuses the window's
    partitioning: no second read of the series."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    train = prepared.filter(F.col(SPLIT) == "train").select(dim, date, IDX, F.col(val).cast("double").alias("y"))
    w = Window.partitionBy(dim).orderBy(IDX)
    z = train.withColumn("z0", F.col("y") - F.lag("y", 1).over(w))
    for k in range(1, P + 1):
        z = z.withColumn(f"z{k}", F.lag("z0", k).over(w))
    full = F.col(f"z{P}").isNotNull()  # rows with every lag: the regression rows
    sums = [F.sum(F.when(full, F.col(f"z{i}") * F.col(f"z{j}"))).alias(f"s{i}{j}")
            for i in range(P + 1) for j in range(i, P + 1)]
    last = F.max_by(F.struct("y", *[f"z{k}" for k in range(P)]), IDX)
    agg = z.groupBy(dim).agg(F.count(F.lit(1)).alias("n_train"), F.max(date).alias("last_date"),
                             last.alias("_last"), *sums)

    def s(i, j):
        return F.coalesce(F.col(f"s{min(i, j)}{max(i, j)}"), F.lit(0.0))

    aug = F.array(*[F.array(*[s(i, j) for j in range(1, P + 1)], s(i, 0)) for i in range(1, P + 1)])
    last_z = F.array(*[F.col(f"_last.z{k}") for k in range(P - 1, -1, -1)])  # oldest first
    return agg.select(dim, "n_train", "last_date", F.col("_last.y").alias("last_y"), last_z.alias("last_z"),
                      _solve(aug).alias("coef"))


def forecast(prepared: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """Forecast rows (dim, date, value, Model, error); too-short or singular
    series get one error row."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    h = cfg.horizon
    st = fit(prepared, cfg)
    ok = (F.col("n_train") >= MIN_TRAIN) & F.col("coef").isNotNull()
    # recursive_forecast takes coefficients in window order (oldest lag first)
    dz = recursive_forecast(F.col("last_z"), F.reverse("coef"), F.lit(0.0), h)
    levels = F.aggregate(dz, F.array().cast("array<double>"),
                         lambda acc, d: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.col("last_y")) + d)))
    good = st.filter(ok).select(dim, "last_date", F.posexplode(levels).alias("k", "v"))
    out = good.select(dim, (F.col("last_date") + F.expr(cfg.step) * (F.col("k") + 1)).alias(date),
                      F.col("v").alias(val), F.lit(MODEL).alias("Model"), F.lit(None).cast("string").alias("error"))
    err = F.when(F.col("n_train") < MIN_TRAIN,
                 F.format_string(f"train has %d periods; {MODEL} needs {MIN_TRAIN}", F.col("n_train"))) \
        .otherwise(F.lit("singular ARIMA system"))
    bad = st.filter(~ok).select(dim, F.col("last_date").alias(date), F.lit(None).cast("double").alias(val),
                                F.lit(MODEL).alias("Model"), err.alias("error"))
    return out.unionByName(bad)
