"""Wide-to-long reshape, row validation with reasons, metric cleanup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.config import SeriesConfig
from ledgerspark.functions.dates import parse_timestamp
from ledgerspark.functions.numeric import nonfinite_to_null, text_to_double
from ledgerspark.session import ensure_checkpoint_dir

METRIC_COLUMNS = ("RMSE", "MAE", "MAPE (%)")
ERROR_FLAG = "Error_Flag"


def reshape_wide(df: DataFrame, id_col: str = "Material", leading: int = 9,
                 date_col: str = "Date", value_col: str = "Sales") -> DataFrame:
    """One row per (id, date column) from a sheet whose columns from
    position ``leading`` on are dates. NULL cells are kept; the other leading
    columns are dropped."""
    if id_col not in df.columns:
        raise ValueError(f"Missing required column(s): {id_col}")
    date_cols = df.columns[leading:]
    if not date_cols:
        raise ValueError("No date columns found after the leading columns")
    types = {df.schema[c].dataType for c in date_cols}
    # Cells of unlike types are carried as text; the value check of R4 sorts them out.
    cells = [F.col(f"`{c}`") if len(types) == 1 else F.col(f"`{c}`").cast("string") for c in date_cols]
    wide = df.select(F.col(f"`{id_col}`"), *[x.alias(c) for x, c in zip(cells, date_cols)])
    return wide.unpivot([id_col], date_cols, date_col, value_col)


_NUM = "_converted_value"


def _flag(df: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """The long table with the parsed date (bad text -> NULL), the converted
    value (``_converted_value``, NULL when not numeric) and ``Error_Flag``
    (reasons in fixed order, each followed by a blank).

    Date parsing and number conversion are computed once, as columns; the
    flags and both outputs only read those columns (no repeated parsing)."""
    dim, date, val = cfg.dimension_col, cfg.date_col, cfg.value_col
    others = [F.col(f"`{c}`") for c in df.columns if c != date]
    typed = isinstance(df.schema[date].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    when = F.col(f"`{date}`").cast("timestamp_ntz") if typed else parse_timestamp(F.col(f"`{date}`"), cfg.date_formats)
    step = df.select(*others, when.alias(date),
                     text_to_double(F.col(f"`{val}`")).alias(_NUM))
    reasons: list[Column] = [
        F.when(F.col(f"`{dim}`").isNull(), F.lit(f"Missing {dim}; ")),
        F.when(F.col(f"`{date}`").isNull(), F.lit(f"Invalid {date}; ")),
        F.when(F.col(f"`{val}`").isNull(), F.lit(f"Missing {val}; ")),
        # numeric exactly when the conversion gives a value (see functions.numeric)
        F.when(F.col(_NUM).isNull(), F.lit(f"Non-numeric {val}; ")),
    ]
    return step.withColumn(ERROR_FLAG, F.concat_ws("", *reasons))


def rows_where(df: DataFrame, cond: Column) -> DataFrame:
    """``df.filter(cond)``, evaluated after ``df``'s projection: each row is
    emitted through ``explode`` of a zero- or one-element array. A plain
    filter on a computed column is pushed below the projection, so every row
    would evaluate the parsing expressions twice (in the filter, then again
    in the projection); the generator keeps them to one evaluation."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    row_type = df.select(row.alias("_r")).schema["_r"].dataType
    none = F.array().cast(T.ArrayType(row_type))
    return df.select(F.explode(F.when(cond, F.array(row)).otherwise(none)).alias("_r")).select("_r.*")


def validate_split(df: DataFrame, cfg: SeriesConfig, materialize: bool = False):
    """``(clean, errors, members)``.

    ``clean`` has no flag column and the value converted to DOUBLE; ``errors``
    keeps the flag and the original value text. Both come from one flagged
    projection, evaluated once per row in each action; ``materialize`` writes
    it to the shared checkpoint folder, so several actions read one parse.
    """
    flagged = _flag(df, cfg)
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        flagged = flagged.checkpoint(eager=True)
    where = DataFrame.filter if materialize else rows_where
    val = cfg.value_col
    clean = (where(flagged, F.col(ERROR_FLAG) == "")
             .withColumn(val, F.col(_NUM)).drop(ERROR_FLAG, _NUM))
    errors = where(flagged, F.col(ERROR_FLAG) != "").drop(_NUM)
    members = clean.select(cfg.dimension_col).distinct()
    return clean, errors, members


def rejected_with_lines(errors: DataFrame, lines: DataFrame) -> DataFrame:
    """The rejected rows of R4 and the lines that were no rows (``files.read_checked``) in one table: R4's columns, as text, the reason,
    and ``line`` and ``file``, which are NULL for rows that R4 rejected."""
    as_text = errors.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in errors.columns])
    return lines.select(*[F.col(f"`{c}`") for c in lines.columns]).unionByName(as_text, allowMissingColumns=True)


def nonfinite_metrics_to_null(df: DataFrame, cols=METRIC_COLUMNS) -> DataFrame:
    """NaN and +-inf in the metric columns become NULL."""
    present = [c for c in cols if c in df.columns]
    return df.select(*[nonfinite_to_null(F.col(f"`{c}`")).alias(c) if c in present else F.col(f"`{c}`")
                       for c in df.columns])


def clean_metrics(df: DataFrame, cols=METRIC_COLUMNS) -> DataFrame:
    """R6, then drop rows lacking any metric present. No metric column ->
    rows kept unchanged."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return nonfinite_metrics_to_null(df, present).dropna(how="any", subset=present)
