"""File sources (delimited files, exported wide sheets, JSON pairs)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerspark.operators.validate import ERROR_FLAG, rows_where

PAIR_SCHEMA = "prompt string, response string"


def source_path(base_dir: str, script_name: str, file_name: str) -> str:
    """``{base}/source_file/{script}/{file}``, the reference's layout."""
    return os.path.join(base_dir, "source_file", script_name, file_name)


def read_delimited(spark: SparkSession, path: str, schema=None, sep: str = ",") -> DataFrame:
    """Header row; an explicit schema when given (inference otherwise).
    A missing path raises instead of returning None."""
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


_CORRUPT = "_corrupt_record"
LINE, FILE = "line", "file"


def file_name() -> Column:
    """The name of the file that a row of a file source came from, as it is in storage (the source escapes it as in addresses)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _line_flag(line: Column, corrupt: Column, n: int, sep: str, escape: str) -> Column:
    """Why a line is no row, or '': quotes first, then the number of fields, then what is left, a value of the wrong type."""
    quote = F.regexp_replace(line, '""' if escape == '"' else '\\\\"', "")  # quotes inside quotes
    s = "\\" + sep
    bare = F.regexp_replace(quote, f'(^|{s})"[^"]*"(?={s}|$)', "$1")  # whole quoted fields go, with the separators in them
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    return (F.when(bare.rlike(f'(^|{s})"'), "Unclosed quote; ")
            .when(corrupt.isNull(), "").when(fields < n, "Missing fields; ").when(fields > n, "Extra fields; ").otherwise("Invalid value; "))


def read_checked(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",", header: bool = True, escape: str = '"',
                 written: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S4 with no line lost: ``(rows, rejected)`` of delimited files.

    A line is a row when its quotes close, it has as many fields as ``schema`` and each reads as its column's type (an empty field
    is NULL). Any other line is in ``rejected``: the columns as text where the line has them, ``Error_Flag`` as R4 names its reasons,
    ``line`` as it stands in the file, and ``file``. Blank lines are no lines. With ``header``, lines in a file's first block that
    name the columns are no rows; a file without a header loses nothing. Quoted fields end on their own line.

    Each line is parsed once per action; with ``written``, a folder in shared storage, once: the checked lines are
    written there and both results read them.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    full = StructType([*fields, StructField(_CORRUPT, StringType())])
    lines = spark.read.text(path).select(F.col("value").alias(LINE), file_name().alias(FILE),
                                         F.col("_metadata.file_block_start").alias("_start"))
    lines = lines.filter(F.trim(LINE) != "")
    if header:
        named = F.lower(F.replace(F.col(LINE), F.lit('"'), F.lit(""))) == sep.join(f.name for f in fields).lower()
        lines = lines.filter(~((F.col("_start") == 0) & named))
    options = {"sep": sep, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    row = F.from_csv(F.col(LINE), _ddl(full), options)
    parsed = lines.select(LINE, FILE, row.alias("_r"))
    flagged = parsed.select(LINE, FILE, "_r", _line_flag(F.col(LINE), F.col("_r")[_CORRUPT], len(fields), sep, escape).alias(ERROR_FLAG))
    where = rows_where
    if written is not None:
        flagged.write.parquet(written)
        flagged, where = spark.read.schema(flagged.schema).parquet(written), DataFrame.filter
    rows = where(flagged, F.col(ERROR_FLAG) == "").select(*[F.col("_r")[f.name].alias(f.name) for f in fields])
    texts = F.from_csv(F.col(LINE), _ddl(StructType([StructField(f.name, StringType()) for f in fields])), {"sep": sep, "escape": escape})
    rejected = where(flagged, F.col(ERROR_FLAG) != "").withColumn("_t", texts)
    return rows, rejected.select(*[F.col("_t")[f.name].alias(f.name) for f in fields], ERROR_FLAG, LINE, FILE)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_wide_sheet(spark: SparkSession, path: str, fmt: str = "csv", schema=None) -> DataFrame:
    """S5 (re-aimed): the monthly sheet exported as CSV or Parquet; column
    order is kept, which R1 relies on. Without a ``schema`` the cells of a CSV are
    text, as R4 takes them: no pass over the file to guess types."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        return spark.read.option("header", True).csv(path)
    return read_delimited(spark, path, schema)


def read_json_pairs(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """prompt/response objects, as a JSON array per file (``multiline``)
    or one object per line."""
    return spark.read.schema(PAIR_SCHEMA).option("multiLine", multiline).json(path)
