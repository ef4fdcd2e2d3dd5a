"""Database sources through Spark's JDBC data source.

The source query runs in the database's own dialect. For parallel reads the
query is wrapped as a derived table so Spark can split it by a numeric or date
column (``query`` alone cannot be partitioned). Filters applied to the
returned DataFrame are pushed into the database by Spark.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession

# URL shapes and driver classes per database kind.
URL_TEMPLATES = {
    "MYSQL": "jdbc:mysql://{host}:{port}/{database}",
    "POSTGRES": "jdbc:postgresql://{host}:{port}/{database}",
    "MSSQL": "jdbc:sqlserver://{host}:{port};databaseName={database}",
    "SNOWFLAKE": "jdbc:snowflake://{account}.snowflakecomputing.com/?db={database}&warehouse={warehouse}",
    "ORACLE": "jdbc:oracle:thin:@//{host}:{port}/{database}",
}
DRIVERS = {
    "MYSQL": "com.mysql.cj.jdbc.Driver",
    "POSTGRES": "org.postgresql.Driver",
    "MSSQL": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "SNOWFLAKE": "net.snowflake.client.jdbc.SnowflakeDriver",
    "ORACLE": "oracle.jdbc.OracleDriver",
}


# Settings that go into the URL where they are given: how they are written, and their names.
OPTIONAL = {
    "MSSQL": (";{}={}", ("encrypt", "trustServerCertificate", "integratedSecurity")),
    "SNOWFLAKE": ("&{}={}", ("schema", "role")),
}
OTHER_NAMES = {"dbname": "database", "server": "host", "username": "user"}
PORTS = {"MYSQL": 3306, "POSTGRES": 5432, "MSSQL": 1433, "ORACLE": 1521}


def jdbc_options(kind: str, config: dict) -> dict:
    """S3: connection options for a database kind; an unknown kind raises.

    ``dbname``, ``server`` and ``username`` may stand for ``database``, ``host`` and ``user``; a port left out is the kind's own. The
    settings of ``OPTIONAL`` (encryption, Snowflake's schema and role) are passed on as given; what is not given is left to the driver."""
    k = kind.upper()
    if k not in URL_TEMPLATES:
        raise ValueError(f"unknown database kind {kind!r}; expected one of {sorted(URL_TEMPLATES)}")
    config = {OTHER_NAMES.get(name, name): value for name, value in config.items()}
    try:
        url = URL_TEMPLATES[k].format(**({"port": PORTS[k]} if k in PORTS else {}) | config)
    except KeyError as e:
        raise ValueError(f"missing connection setting {e.args[0]!r} for {k}") from None
    form, names = OPTIONAL.get(k, ("", ()))
    for name in names:
        if config.get(name) is not None:
            value = str(config[name]).lower() if isinstance(config[name], bool) else str(config[name])
            if any(c in value for c in ";&=?{}"):
                raise ValueError(f"setting {name!r} may not hold {value!r}")
            url += form.format(name, value)
    opts = {"url": url, "driver": DRIVERS[k]}
    for key in ("user", "password"):
        if key in config:
            opts[key] = config[key]
    return opts


def sql_literal(value) -> str:
    """A typed SQL literal for one bound parameter."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(value) if not isinstance(value, decimal.Decimal) else str(value)
    if isinstance(value, dt.datetime):
        return "'" + value.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3] + "'"
    if isinstance(value, dt.date):
        return "'" + value.isoformat() + "'"
    text = str(value)
    if "\\" in text or any(ord(ch) < 32 for ch in text):  # some dialects read escapes inside quotes
        raise ValueError("a text parameter may hold no backslash or control character")
    return "'" + text.replace("'", "''") + "'"


def bind_parameters(sql: str, params) -> str:
    """Fill positional ``%s`` markers with typed literals (JDBC reads take
    no bind parameters). ``%%`` stands for a literal percent sign."""
    if not params:
        return sql
    parts = sql.replace("%%", "\0").split("%s")
    if len(parts) - 1 != len(params):
        raise ValueError(f"query has {len(parts) - 1} markers but {len(params)} parameters were given")
    out = parts[0]
    for lit, rest in zip(params, parts[1:]):
        out += sql_literal(lit) + rest
    return out.replace("\0", "%")


def read_query(spark: SparkSession, options: dict, sql: str, params=None, partition_column: str | None = None,
               lower=None, upper=None, num_partitions: int | None = None, fetchsize: int = 50000) -> DataFrame:
    """Rows of a source query as a DataFrame (column names from the cursor).

    With ``partition_column`` the read is split into ``num_partitions`` range
    queries that run in parallel on the executors."""
    text = bind_parameters(sql, params)
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetchsize)
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned reads need lower, upper and num_partitions")
        reader = (reader.option("dbtable", f"({text}) src")
                  .option("partitionColumn", partition_column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", text)
    return reader.load()


def date_range_predicates(column: str, start: dt.datetime, end: dt.datetime, parts: int) -> list[str]:
    """Split the closed window [start, end] into ``parts`` non-overlapping
    predicates ``start_i <= col < start_(i+1)`` (the last one closed), so a
    windowed extraction (P6) runs as ``parts`` parallel range queries."""
    if parts < 1 or end < start:
        raise ValueError("need parts >= 1 and start <= end")
    step = (end - start) / parts
    bounds = [start + step * i for i in range(parts)] + [end]
    preds = []
    for i in range(parts):
        lo, hi = sql_literal(bounds[i]), sql_literal(bounds[i + 1])
        op = "<=" if i == parts - 1 else "<"
        preds.append(f"{column} >= {lo} AND {column} {op} {hi}")
    return preds


def read_table_by_predicates(spark: SparkSession, options: dict, table: str, predicates: list[str],
                             fetchsize: int = 50000) -> DataFrame:
    """S1 for large windows: one JDBC partition per predicate (rows outside
    every predicate are not read; overlapping predicates would read twice)."""
    props = {k: v for k, v in options.items() if k != "url"}
    props["fetchsize"] = str(fetchsize)
    return spark.read.jdbc(options["url"], table, predicates=predicates, properties=props)
