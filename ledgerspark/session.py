"""Session helpers.

The library never builds its own cluster settings on top of a session it is
handed; ``get_spark`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def get_spark(master: str | None = None, app: str = "ledgerspark",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        # a few partitions per core: AQE coalesces small shuffles, and compute-heavy
        # per-series stages (explicit repartition) spread evenly over the slots
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 3 * int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting (session conf, SparkConf, or a checkpoint
    folder already set on the context) points at shared storage and is used
    as is. Only when none is set (local tests) is a fresh scratch folder chosen.
    """
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
               or sc.getCheckpointDir())
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        if not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", current)
        return current
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="ledgerspark-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerspark`` importable in the Python workers (grouped maps pickle
    references to its functions): zip the package once per SparkContext and
    hand it to ``addPyFile``, which distributes it to every executor."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerspark_shipped", False):
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerspark-pkg-"), "ledgerspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._ledgerspark_shipped = True


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver-generated table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]
