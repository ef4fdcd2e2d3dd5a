"""Loads seen whole, archives that lose nothing, files that lose no line, and file logs."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerspark import storage
from ledgerspark.operators import control, validate
from ledgerspark.config import SeriesConfig
from ledgerspark.sinks import archive, tables as tsink
from ledgerspark.sinks.publish import COMMITS, PublishedTables, StaleVersion
from ledgerspark.sinks.tables import ParquetTarget
from ledgerspark.sources import files as fsrc
from ledgerspark.streaming import csv_ingest

ON = dt.date(2024, 2, 9)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def lie(base):
    out = {}
    for folder, _, files in os.walk(base):
        for f in files:
            if not f.endswith(".crc"):
                out[os.path.relpath(os.path.join(folder, f), base)] = open(os.path.join(folder, f), encoding="latin-1").read()
    return out


# --- K11 ------------------------------------------------------------------------------------------

def test_ready_files_with_the_prefix_are_archived_once(spark, tmp_dir):
    ready = os.path.join(tmp_dir, "a[1]*", "Finale")
    for name, text in {"a[1]*_x.csv": "1", "a[1]*_y.csv": "2", "b.csv": "3", "a1.csv": "4", ".a[1]*.swp": "5", "sub/a[1]*_z.csv": "6"}.items():
        put(os.path.join(ready, name), text)
    os.makedirs(os.path.join(tmp_dir, "a[1]*", "archive", "20240201"))
    os.makedirs(os.path.join(tmp_dir, "a[1]*", "archive", "20240202"))
    os.makedirs(os.path.join(tmp_dir, "a[1]*", "archive", "20240299"))
    moved, gone = archive.archive_run(spark, tmp_dir, "a[1]*", ON)
    want = {"Finale/b.csv": "3", "Finale/a1.csv": "4", "Finale/.a[1]*.swp": "5", "Finale/sub/a[1]*_z.csv": "6", "archive/20240209/a[1]*_x.csv": "1", "archive/20240209/a[1]*_y.csv": "2"}
    assert lie(os.path.join(tmp_dir, "a[1]*")) == want
    assert sorted(map(tuple, moved.collect())) == [("a[1]*_x.csv", "a[1]*_x.csv", 1, "moved"), ("a[1]*_y.csv", "a[1]*_y.csv", 1, "moved")]
    assert gone == ["20240201"] and sorted(os.listdir(os.path.join(tmp_dir, "a[1]*", "archive"))) == ["20240202", "20240209", "20240299"]
    again, gone = archive.archive_run(spark, tmp_dir, "a[1]*", ON)
    assert again.count() == 0 and gone == [] and lie(os.path.join(tmp_dir, "a[1]*")) == want


def test_nothing_in_the_archive_is_overwritten(spark, tmp_dir):
    day = archive.run_folders(spark, tmp_dir, "s", ON)
    put(os.path.join(day["day"], "s.tar.gz"), "old")
    put(os.path.join(day["day"], "s_same.csv"), "same")
    put(os.path.join(day["ready"], "s.tar.gz"), "new")
    put(os.path.join(day["ready"], "s_same.csv"), "same")  # what a copy without its delete leaves
    out = archive.archive_ready(spark, day["ready"], day["day"], "s")
    assert sorted((r.file, r.archived_as, r.outcome) for r in out.collect()) == [("s.tar.gz", "s.1.tar.gz", "renamed"), ("s_same.csv", "s_same.csv", "repeated")]
    assert lie(day["script"]) == {"archive/20240209/s.tar.gz": "old", "archive/20240209/s.1.tar.gz": "new", "archive/20240209/s_same.csv": "same"}


def test_inventory_and_published_names(spark, tmp_dir):
    spark.range(10).repartition(2).write.option("header", True).csv(os.path.join(tmp_dir, "w"))
    names = archive.publish_files(spark, os.path.join(tmp_dir, "w"), os.path.join(tmp_dir, "s", "Finale"), "s")
    assert names == ["s_00000.csv", "s_00001.csv"]
    with pytest.raises(FileExistsError):
        spark.range(1).write.csv(os.path.join(tmp_dir, "w2"))
        archive.publish_files(spark, os.path.join(tmp_dir, "w2"), os.path.join(tmp_dir, "s", "Finale"), "s")
    archive.archive_run(spark, tmp_dir, "s", ON)
    put(os.path.join(tmp_dir, "s", "analysis", "deep", "r.txt"), "abc")
    got = sorted((tuple(r) for r in archive.inventory(spark, tmp_dir, "s").select("place", "day", "file").collect()), key=str)
    assert got == [("analysis", None, "r.txt"), ("archive", "20240209", "s_00000.csv"), ("archive", "20240209", "s_00001.csv")]
    assert archive.inventory(spark, tmp_dir, "none").count() == 0


# --- K1-K3: publishing ----------------------------------------------------------------------------

def total(store, spark, table, version=None):
    return store.read(spark, table, version).agg(F.sum("id")).first()[0]


def failing(spark, n=100):
    return spark.range(n, numPartitions=4).withColumn("id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))


def test_a_failure_between_two_tables_leaves_all_old_ones(spark, tmp_dir):
    store = PublishedTables(tmp_dir)
    assert tsink.upload({"a": spark.range(10), "b": spark.range(20)}, "s", store) == {"s_a": 10, "s_b": 20}
    before = lie(tmp_dir).keys()
    with pytest.raises(Exception, match="boom"):
        tsink.upload({"a": spark.range(5), "b": failing(spark)}, "s", store)
    assert (total(store, spark, "s_a"), total(store, spark, "s_b")) == (45, 190)
    assert lie(tmp_dir).keys() == before and store.versions(spark) == [1]  # nothing staged is left


def test_append_replace_versions_and_expiry(spark, tmp_dir):
    store = PublishedTables(tmp_dir, "stage")
    store.write(spark.range(3), "t", append=True)
    store.write(spark.range(4), "t", append=True)
    store.publish({"t": spark.range(2), "u": spark.range(1)}, append=lambda t: t == "t")
    assert [total(store, spark, "t", v) for v in (1, 2, 3)] == [3, 9, 10]
    opened = store.read(spark, "t", 3)
    store.write(spark.range(0), "t", append=False)
    assert store.read(spark, "t").count() == 0 and total(store, spark, "u") == 0
    assert opened.count() == 9  # a reader keeps the version that it opened
    assert sorted(map(tuple, store.report(spark, 3).collect())) == [("stage.t", 9, 3), ("stage.u", 1, 1)]
    assert store.expire(spark, keep=2) == [] and store.versions(spark) == [3, 4]
    assert len(store.expire(spark, keep=1)) == 3 and store.versions(spark) == [4]
    assert store.read(spark, "t").count() == 0 and total(store, spark, "u") == 0
    with pytest.raises(ValueError, match="columns"):
        store.write(spark.range(2).withColumn("x", F.lit(1)), "t", append=True)
    with pytest.raises(KeyError):
        store.read(spark, "none")
    assert store.publish({}) == {}


def test_two_loads_at_once_both_count(spark, tmp_dir):
    store, errors = PublishedTables(tmp_dir), []
    store.write(spark.range(1), "t", append=False)

    def load(i):
        try:
            store.publish({"t": spark.range(10), f"own{i}": spark.range(i)}, append=lambda t: t == "t")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=load, args=(i,)) for i in (1, 2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and store.versions(spark) == [1, 2, 3, 4]
    assert store.read(spark, "t").count() == 31 and [store.read(spark, f"own{i}").count() for i in (1, 2, 3)] == [1, 2, 3]


def test_a_commit_number_is_taken_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, COMMITS, "x.json")
    storage.make_folder(spark, os.path.dirname(path))
    assert storage.write_new_text(spark, path, "one") and not storage.write_new_text(spark, path, "two")
    assert storage.read_text(spark, path) == "one" and len(storage.entries(spark, os.path.dirname(path))) == 1


def test_stale_loads_fail_and_leave_nothing(spark, tmp_dir):
    store = PublishedTables(tmp_dir)
    store.write(spark.range(3), "t", append=False)
    with pytest.raises(StaleVersion):
        store.publish({"t": spark.range(9)}, expected=0)
    assert store.read(spark, "t").count() == 3 and len([f for f in lie(tmp_dir) if f.startswith("t/")]) == len(lie(os.path.join(tmp_dir, "t")))
    assert len({f.split("/")[1] for f in lie(tmp_dir) if f.startswith("t/")}) == 1


def test_loaders_and_batch_sizes(spark, tmp_dir):
    jdbc = tsink.JdbcTarget({"url": "x"})
    assert tsink._with_options(jdbc, batchsize=tsink.BATCH_POSTGRES).batchsize == 5000
    assert tsink._with_options(jdbc, batchsize=tsink.BATCH_GENERAL, schema="s").table_name("t") == "s.t"
    for target in (PublishedTables(os.path.join(tmp_dir, "p")), ParquetTarget(os.path.join(tmp_dir, "q"))):
        assert tsink.load_replace({"a": spark.range(3)}, "x", target) == {"x_a": 3}
        assert tsink.load_replace({"a": spark.range(2)}, "x", target) == {"x_a": 2}
        assert tsink.load_into({"a": spark.range(4)}, "x", target, "deep") == {"x_a": 4}
        assert tsink.load_into({"a": spark.range(4)}, "x", target, "deep", append=True) == {"x_a": 4}
        assert target.read(spark, "x_a").count() == 2
        assert type(target)(target.base_path, schema="deep").read(spark, "x_a").count() == 8


# --- S4 -------------------------------------------------------------------------------------------

LINES = ["id,name,q", "1,ann,2.5", "2,bob", '3,"c,d",1', "4,x,1,9", '5,"open,3', '6,z,"7', "7,y,abc", "", "   ", '8,"a ""b"" c",1', '9,say "hi",2', '10,"a"b,4', ",,", "11,,", '12,"",3', 'x,"q, ""r",1',
         "13,é日本,1e2", '14,"""""",1']


@pytest.mark.parametrize("written", [False, True])
def test_no_line_is_lost(spark, tmp_dir, written):
    put(os.path.join(tmp_dir, "in", "a.csv"), "\n".join(LINES))
    put(os.path.join(tmp_dir, "in", "b.csv"), "\n".join(['"ID",name,"q"', "20,b,1", "id,name,q"]))
    put(os.path.join(tmp_dir, "in", "c.csv"), "30,no header,1\n")
    put(os.path.join(tmp_dir, "in", "d.csv"), "")
    rows, bad = fsrc.read_checked(spark, os.path.join(tmp_dir, "in"), "id int, name string, q double", written=os.path.join(tmp_dir, "w") if written else None)
    assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, [
        (1, "ann", 2.5), (3, "c,d", 1.0), (8, 'a "b" c', 1.0), (9, 'say "hi"', 2.0), (None, None, None), (11, None, None), (12, None, 3.0), (13, "é日本", 100.0), (14, '""', 1.0),
        (20, "b", 1.0), (30, "no header", 1.0)]))
    got = {r.line: (r.Error_Flag, r.file) for r in bad.collect()}
    assert got == {"2,bob": ("Missing fields; ", "a.csv"), "4,x,1,9": ("Extra fields; ", "a.csv"), '5,"open,3': ("Unclosed quote; ", "a.csv"), '6,z,"7': ("Unclosed quote; ", "a.csv"),
                   "7,y,abc": ("Invalid value; ", "a.csv"), '10,"a"b,4': ("Unclosed quote; ", "a.csv"), 'x,"q, ""r",1': ("Invalid value; ", "a.csv")}
    first = {r.line: (r.id, r.name, r.q) for r in bad.collect()}
    assert first["7,y,abc"] == ("7", "y", "abc") and first["2,bob"][:2] == ("2", "bob")


def test_other_separators_and_a_long_quoted_field(spark, tmp_dir):
    long = "x" * 200_000
    put(os.path.join(tmp_dir, "in", "a.txt"), f'1|"{long}|y"\n2|a,b\n3|"|\n4\n')
    rows, bad = fsrc.read_checked(spark, os.path.join(tmp_dir, "in"), "id int, `a b` string", sep="|", header=False)
    assert {(r[0], r[1]) for r in rows.collect()} == {(1, long + "|y"), (2, "a,b")}
    assert sorted((r.line, r.Error_Flag) for r in bad.collect()) == [('3|"|', "Unclosed quote; "), ("4", "Missing fields; ")]


def test_rejected_rows_and_lines_in_one_table(spark, tmp_dir):
    put(os.path.join(tmp_dir, "in", "a.csv"), "p,d,v\na,2024-01-01,1\nb,soon,2\nc,2024-01-01\n")
    rows, bad = fsrc.read_checked(spark, os.path.join(tmp_dir, "in"), "p string, d string, v string")
    clean, errors, _ = validate.validate_split(rows, SeriesConfig("p", "d", "v"))
    out = validate.rejected_with_lines(errors, bad)
    assert clean.count() == 1
    assert sorted((r.p, r.Error_Flag, r.line, r.file) for r in out.collect()) == [("b", "Invalid d; ", None, None), ("c", "Missing fields; ", "c,2024-01-01", "a.csv")]


# --- K6 -------------------------------------------------------------------------------------------

def test_files_are_logged_with_their_rows(spark, tmp_dir):
    target, landing = ParquetTarget(os.path.join(tmp_dir, "t")), os.path.join(tmp_dir, "in")

    def run():
        return csv_ingest.ingest_new_csv(spark, landing, "id bigint", target, "t", os.path.join(tmp_dir, "archive"), os.path.join(tmp_dir, "cp"), max_files_per_trigger=1)

    for name, n in (("a.csv", 3), ("b=1 +%20é.csv", 5), ("empty.csv", 0)):
        put(os.path.join(landing, name), "id\n" + "".join(f"{i}\n" for i in range(n)))
    assert sum(r["rows"] for r in run()) == 8
    log = {r.file: r.rows for r in csv_ingest.file_log(spark, target, "t").collect()}
    assert log == {"a.csv": 3, "b=1 +%20é.csv": 5}
    last = max(r.batch_id for r in csv_ingest.file_log(spark, target, "t").collect())
    again = target.read(spark, "t").filter(F.col("batch_id") == last).select("id", csv_ingest.FILE)
    again = spark.createDataFrame([tuple(r) for r in again.collect()], "id bigint, source_file string")
    csv_ingest.load_batch(again, last, target, "t")
    assert {r.file: r.rows for r in csv_ingest.file_log(spark, target, "t").collect()} == log and target.read(spark, "t").count() == 8
    put(os.path.join(landing, "c.csv"), "id\n9\n")
    assert sum(r["rows"] for r in run()) == 1 and csv_ingest.file_log(spark, target, "t").count() == 3


# --- C3-C5 ----------------------------------------------------------------------------------------

def run_row(script, kind, day):
    return (script, dt.datetime(2024, 1, day), dt.datetime(2024, 1, day, 1), dt.date(2024, 1, day), "Completed", kind)


RUNS = "script_name string, start_datetime timestamp_ntz, end_datetime timestamp_ntz, rundate date, status string, load_type string"


def test_the_log_and_its_history_change_together(spark, tmp_dir):
    store = PublishedTables(tmp_dir)
    control.record_runs(spark, store, spark.createDataFrame([run_row("a", "full", 1), run_row("b", "full", 1)], RUNS))
    opened = store.manifest(spark)
    control.record_runs(spark, store, spark.createDataFrame([run_row("a", "incremental", 2), run_row("new", "incremental", 2)], RUNS))
    days = {r.script_name: r.rundate.day for r in store.read(spark, "logs").collect()}
    assert days == {"a": 2, "b": 1} and store.read(spark, "logs_history").count() == 4
    assert {r.rundate.day for r in store.read_from(spark, "logs", opened).collect()} == {1} and store.versions(spark) == [1, 2]


def test_an_upsert_is_computed_again_from_a_newer_log(spark, tmp_dir, monkeypatch):
    store, raced = PublishedTables(tmp_dir), []
    control.record_runs(spark, store, spark.createDataFrame([run_row("a", "full", 1)], RUNS))
    plain = PublishedTables.publish

    def publish(self, frames, *args, **options):
        if options.get("expected") is not None and not raced:
            raced.append(1)
            plain(store, {"logs": spark.createDataFrame([run_row("a", "full", 1), run_row("b", "full", 3)], RUNS)})
        return plain(self, frames, *args, **options)

    monkeypatch.setattr(PublishedTables, "publish", publish)
    control.record_runs(spark, store, spark.createDataFrame([run_row("b", "incremental", 5)], RUNS))
    assert {(r.script_name, r.rundate.day) for r in store.read(spark, "logs").collect()} == {("a", 1), ("b", 5)}
