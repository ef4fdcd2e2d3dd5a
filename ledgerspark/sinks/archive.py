"""The folders of a load script, its ready files moved to ``archive/yyyyMMdd``, and retention.

A script's base folder holds ``Finale`` (files ready to load), ``analysis`` and ``archive`` with one folder per day. A run
archives the ready files whose names start with the script's name and deletes day folders past retention. Files are moved by
renaming, one after another, so a run that ends midway is finished by the next one:

* a file already moved is no longer ready, and is left alone;
* a copy that an object store left behind (its rename is copy and delete) has the archived file's bytes and is deleted;
* a new file with an archived file's name and other bytes takes a free name, ``name.1.csv`` and so on: nothing in the
  archive is overwritten.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import storage
from ledgerspark.config import ARCHIVE_RETENTION_DAYS
from ledgerspark.sinks.files import delete_expired_folders

READY, ARCHIVE, ANALYSIS = "Finale", "archive", "analysis"  # fixed values: folder names of a script
MOVE_SCHEMA = "file string, archived_as string, bytes long, outcome string"


def run_folders(spark: SparkSession, base: str, script: str, on: dt.date) -> dict[str, str]:
    """The folders of a script's run, made where they are missing."""
    root = os.path.join(base, script)
    folders = {"script": root, "archive": os.path.join(root, ARCHIVE), "day": os.path.join(root, ARCHIVE, on.strftime("%Y%m%d")),
               "ready": os.path.join(root, READY), "analysis": os.path.join(root, ANALYSIS)}
    for folder in folders.values():
        storage.make_folder(spark, folder)
    return folders


def publish_files(spark: SparkSession, written: str, folder: str, name: str) -> list[str]:
    """Give the part files of a dataset that Spark wrote plain names, ``name_00000.csv`` and so on in part order, in ``folder``
    (a ready folder). Returns the names. Markers and empty folders are left behind."""
    storage.make_folder(spark, folder)
    out = []
    parts = [e for e in storage.entries(spark, written) if not e.is_dir and e.name.startswith("part-")]
    for i, part in enumerate(parts):
        ending = part.name[part.name.index("."):] if "." in part.name else ""
        out.append(f"{name}_{i:05d}{ending}")
        if not storage.rename_new(spark, part.path, os.path.join(folder, out[-1])):
            raise FileExistsError(os.path.join(folder, out[-1]))
    return out


def _free_name(name: str, n: int) -> str:
    stem, dot, ending = name.partition(".")
    return f"{stem}.{n}{dot}{ending}" if n else name


def move_file(spark: SparkSession, file: storage.Entry, folder: str) -> tuple[str, str]:
    """Move one file into ``folder``; (name there, outcome): moved, renamed (the name was taken), or repeated (was there already)."""
    n = 0
    while True:
        name = _free_name(file.name, n)
        target = os.path.join(folder, name)
        if storage.rename_new(spark, file.path, target):
            return name, "renamed" if n else "moved"
        if storage.same_content(spark, file.path, target):
            storage.delete(spark, file.path)
            return name, "repeated"
        n += 1


def archive_ready(spark: SparkSession, ready: str, day_folder: str, starts_with: str) -> DataFrame:
    """Move the files of ``ready`` whose names start with ``starts_with`` (as plain text) into ``day_folder``; folders, hidden files and all other
    files stay. Returns one row per file moved: file, archived_as, bytes, outcome. Nothing to move is no error."""
    rows = []
    for file in storage.entries(spark, ready):
        if not file.is_dir and file.name.startswith(starts_with) and not file.name.startswith((".", "_")):
            rows.append((file.name, *move_file(spark, file, day_folder), file.bytes))
    return spark.createDataFrame([(f, a, b, o) for f, a, o, b in rows], MOVE_SCHEMA)


def archive_run(spark: SparkSession, base: str, script: str, on: dt.date, days: int = ARCHIVE_RETENTION_DAYS) -> tuple[DataFrame, list[str]]:
    """One run's housekeeping: folders, the move, then retention. Returns the moved files and the deleted day folders."""
    folders = run_folders(spark, base, script, on)
    moved = archive_ready(spark, folders["ready"], folders["day"], script)
    return moved, delete_expired_folders(spark, folders["archive"], on, days)


def inventory(spark: SparkSession, base: str, script: str) -> DataFrame:
    """What lies where in a script's folders: place (``Finale``, ``archive``, ``analysis``), day (of the archive), file, bytes."""
    files = storage.listing(spark, os.path.join(base, script))
    place = F.split("folder", "/")
    return files.select(place[0].alias("place"), F.when(place[0] == ARCHIVE, F.try_element_at(place, F.lit(2))).alias("day"), "file", "bytes")
