"""Configuration objects (the reference passes a nine-key dict around)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults for the same results.
DEFAULT_MIN_HISTORY = 24
DEFAULT_TEST_SIZE = 12
DEFAULT_FORECAST_PERIODS = 12
DEFAULT_WINDOW = 12
FULL_LOAD_LOOKBACK_DAYS = 6000
ARCHIVE_RETENTION_DAYS = 7

# Period aliases accepted for resampling: alias -> (date_trunc unit, step interval).
FREQUENCIES = {
    "h": ("hour", "INTERVAL 1 HOUR"),
    "D": ("day", "INTERVAL 1 DAY"),
    "MS": ("month", "INTERVAL 1 MONTH"),
    "QS": ("quarter", "INTERVAL 3 MONTH"),
    "YS": ("year", "INTERVAL 1 YEAR"),
}


@dataclass(frozen=True)
class SeriesConfig:
    """Names and sizes for a many-series forecast run."""

    dimension_col: str
    date_col: str
    value_col: str
    freq: str = "MS"
    min_history: int = DEFAULT_MIN_HISTORY
    test_mode: bool = True
    test_size: int = DEFAULT_TEST_SIZE
    forecast_periods: int = DEFAULT_FORECAST_PERIODS
    window_size: int = DEFAULT_WINDOW
    # Sums of DOUBLE values that do not depend on the order of rows or partitions (one more pass over the value column).
    stable_sums: bool = False
    # Bins per task of one series when resampling; None keeps a series in one task (fewer shuffles).
    segment_bins: int | None = None
    # Holt-Winters: values tried for each smoothing parameter, then rounds of a box that shrinks around each series' best point.
    smoothing_grid: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7, 0.9)
    smoothing_rounds: int = 0
    # Accepted text formats for the date column, tried in order.
    date_formats: tuple[str, ...] = field(
        default=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"))

    def __post_init__(self):
        if self.freq not in FREQUENCIES:
            raise ValueError(f"unsupported freq {self.freq!r}; use one of {sorted(FREQUENCIES)}")
        if self.test_mode and self.test_size <= 0:
            raise ValueError("test_size must be positive in test mode")
        if self.segment_bins is not None and self.segment_bins < 1:
            raise ValueError("segment_bins must be positive")
        if not self.smoothing_grid or self.smoothing_rounds < 0 or not all(0 <= x <= 1 for x in self.smoothing_grid):
            raise ValueError("smoothing_grid needs values from 0 to 1, smoothing_rounds must not be negative")
        if self.min_history < 1 or self.forecast_periods < 1 or self.window_size < 1:
            raise ValueError("min_history, forecast_periods and window_size must be positive")

    @property
    def horizon(self) -> int:
        return self.test_size if self.test_mode else self.forecast_periods

    @property
    def trunc_unit(self) -> str:
        return FREQUENCIES[self.freq][0]

    @property
    def step(self) -> str:
        return FREQUENCIES[self.freq][1]
