"""Files through the Hadoop file system of their path (local, HDFS, object store): listing, moving, small text files.

These are calls about names, made by the driver; contents are read and written by Spark jobs.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    bytes: int
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies directly in a folder, by name; nothing if there is no such folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = [Entry(s.getPath().toString(), s.getPath().getName(), int(s.getLen()), bool(s.isDirectory())) for s in fs.listStatus(p)]
    return sorted(out, key=lambda e: e.name)


def make_folder(spark: SparkSession, folder: str) -> str:
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def same_content(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two files hold the same bytes, compared as streams."""
    fs_a, pa = _fs(spark, a)
    fs_b, pb = _fs(spark, b)
    if fs_a.getFileStatus(pa).getLen() != fs_b.getFileStatus(pb).getLen():
        return False
    left, right = fs_a.open(pa), fs_b.open(pb)
    try:
        return bool(spark._jvm.org.apache.commons.io.IOUtils.contentEquals(left, right))
    finally:
        left.close()
        right.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless ``target`` exists; False then, with nothing changed."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).getFileSystem(conf).getUri(), conf)
    none = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(path(source), path(target), none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole: readers see all of it or none. False if it exists already."""
    attempt = os.path.join(os.path.dirname(path), f"_attempt-{uuid.uuid4().hex}")
    fs, p = _fs(spark, attempt)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if rename_new(spark, attempt, path):
        return True
    fs.delete(p, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listing(spark: SparkSession, base: str) -> DataFrame:
    """(folder, file, bytes) of every file below ``base``, folder relative to it: a Spark job over names and lengths, which
    reads no content."""
    schema = "folder string, file string, bytes long"
    if not exists(spark, base):
        return spark.createDataFrame([], schema)
    _, p = _fs(spark, base)
    root = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path", "length")
    # paths of the source and of the file system differ in the number of slashes after the scheme
    plain = F.regexp_replace("path", "^([a-z0-9+.-]+):/+", "$1:/")
    inside = F.substring(plain, len(root.replace(":///", ":/")) + 2, 1 << 30) if ":///" in root or "://" not in root else F.substring("path", len(root) + 2, 1 << 30)
    at = F.length(inside) - F.length(F.substring_index(inside, "/", -1))
    return files.select(F.substring(inside, F.lit(1), F.greatest(at - 1, F.lit(0))).alias("folder"), F.substring_index(inside, "/", -1).alias("file"),
                        F.col("length").alias("bytes"))
