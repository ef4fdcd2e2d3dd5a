"""Sources, sinks and the incremental CSV load."""

import datetime as dt
import os

import pytest

from ledgerspark.sinks import files as fsink
from ledgerspark.sinks import tables as tsink
from ledgerspark.sources import extract, files as fsrc, jdbc
from ledgerspark.streaming import csv_ingest


def test_jdbc_options_and_binding():
    o = jdbc.jdbc_options("mysql", {"host": "h", "port": 3306, "database": "db", "user": "u", "password": "p"})
    assert o["url"] == "jdbc:mysql://h:3306/db" and o["user"] == "u" and o["driver"].endswith("Driver")
    with pytest.raises(ValueError, match="unknown database kind"):
        jdbc.jdbc_options("sqlite", {})
    with pytest.raises(ValueError, match="missing connection setting"):
        jdbc.jdbc_options("POSTGRES", {"host": "h"})
    assert jdbc.jdbc_options("mssql", {"server": "h", "database": "d", "encrypt": True})["url"] == "jdbc:sqlserver://h:1433;databaseName=d;encrypt=true"
    assert jdbc.jdbc_options("mssql", {"host": "h", "port": 9, "database": "d"})["url"] == "jdbc:sqlserver://h:9;databaseName=d"
    assert jdbc.jdbc_options("postgres", {"host": "h", "dbname": "d", "username": "u"}) == {"url": "jdbc:postgresql://h:5432/d", "driver": "org.postgresql.Driver", "user": "u"}
    flake = {"account": "a", "database": "d", "warehouse": "w", "schema": "s", "role": "r"}
    assert jdbc.jdbc_options("snowflake", flake)["url"].endswith("/?db=d&warehouse=w&schema=s&role=r")
    with pytest.raises(ValueError, match="may not hold"):
        jdbc.jdbc_options("snowflake", flake | {"role": "r&x=1"})
    sql = jdbc.bind_parameters("SELECT * FROM t WHERE d BETWEEN %s AND %s AND n = %s AND s LIKE 'a%%'",
                               (dt.datetime(2024, 1, 1), dt.date(2024, 1, 31), "O'Brien"))
    assert sql == ("SELECT * FROM t WHERE d BETWEEN '2024-01-01 00:00:00.000' AND '2024-01-31' "
                   "AND n = 'O''Brien' AND s LIKE 'a%'")
    with pytest.raises(ValueError):
        jdbc.bind_parameters("SELECT %s", (1, 2))


def test_csv_writer_rules_and_reader(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "k int, v string")
    [one] = fsink.write_csv(a, tmp_dir, "single")
    two = fsink.write_csv([a, b], tmp_dir, "many")
    assert [os.path.basename(p) for p in two] == ["many_1", "many_2"]
    with pytest.raises(ValueError):
        fsink.write_csv([], tmp_dir, "none")
    assert fsrc.read_delimited(spark, one, "k int, v string").collect()[0].v == "x"
    with pytest.raises(ValueError, match="sheet names"):
        fsink.export_named([a, b], ["only_one"], tmp_dir)


def test_json_pairs_list_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pairs.json")
    with open(path, "w") as f:
        f.write('[{"prompt": "p1", "response": "r1"}, {"prompt": "p2", "response": null}]')
    rows = fsrc.read_json_pairs(spark, path).collect()
    assert [(r.prompt, r.response) for r in rows] == [("p1", "r1"), ("p2", None)]


def test_upload_counts_and_audit(spark, tmp_dir):
    df = spark.range(10).withColumnRenamed("id", "k")
    target = tsink.ParquetTarget(tmp_dir)
    c1 = tsink.upload({"a": df, "b": df.limit(3)}, "job", target)
    assert c1 == {"job_a": 10, "job_b": 3}
    tsink.upload({"a": df}, "job", target, append=True)
    assert target.read(spark, "job_a").count() == 20
    tsink.upload({"a": df}, "job", target)  # replace
    assert target.read(spark, "job_a").count() == 10
    audit = tsink.append_audit(spark, "job", c1, dt.date(2024, 1, 1), target)
    assert sorted(tuple(r)[:3] for r in audit.collect()) == [("job", "job_a", 10), ("job", "job_b", 3)]


def test_expire_day_folders(spark, tmp_dir):
    for name in ("day=20240120", "day=20240124", "day=20240131", "day=junk"):
        spark.range(1).write.parquet(os.path.join(tmp_dir, name))
    deleted = fsink.delete_expired_folders(spark, tmp_dir, dt.date(2024, 1, 31), 7, key="day")
    assert deleted == ["day=20240120"]
    assert sorted(os.listdir(tmp_dir)) == ["day=20240124", "day=20240131", "day=junk"]


def test_incremental_csv_ingest_loads_each_file_once(spark, tmp_dir):
    landing, archive = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "archive")
    os.makedirs(landing)
    target = tsink.ParquetTarget(os.path.join(tmp_dir, "stage"))
    ckpt = os.path.join(tmp_dir, "ckpt")
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("k,v\n1,x\n2,y\n")
    log1 = csv_ingest.ingest_new_csv(spark, landing, "k int, v string", target, "t", archive, ckpt)
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write("k,v\n3,z\n")
    log2 = csv_ingest.ingest_new_csv(spark, landing, "k int, v string", target, "t", archive, ckpt)
    assert sum(x["rows"] for x in log1) == 2 and sum(x["rows"] for x in log2) == 1
    assert sorted(r.k for r in target.read(spark, "t").collect()) == [1, 2, 3]
    # files of committed batches move to the archive (the newest one on a later run)
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "a.csv" in archived
    assert not os.path.exists(os.path.join(landing, "a.csv"))


def test_extract_and_concurrent_actions(spark):
    src = extract.extract_all({"a": lambda: spark.range(5), "b": lambda: spark.range(7)})
    out = extract.run_concurrently({k: v.count for k, v in src.items()})
    assert out == {"a": 5, "b": 7}
    with pytest.raises(RuntimeError, match="'bad'"):
        extract.extract_all({"bad": lambda: 1 / 0})


def test_date_range_predicates_cover_window_once():
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 12)
    preds = jdbc.date_range_predicates("d", start, end, 4)
    assert len(preds) == 4
    assert preds[0].startswith("d >= '2024-01-01 00:00:00.000' AND d < ")
    assert preds[-1].endswith("d <= '2024-01-31 12:00:00.000'")
    # consecutive predicates share a bound: each upper bound is the next lower bound
    uppers = [p.split(" AND ")[1].split(" ", 2)[2] for p in preds[:-1]]
    lowers = [p.split(" AND ")[0].split(" ", 2)[2] for p in preds[1:]]
    assert uppers == lowers
    with pytest.raises(ValueError):
        jdbc.date_range_predicates("d", end, start, 2)


def test_replayed_batch_loads_once(spark, tmp_dir):
    target = tsink.ParquetTarget(os.path.join(tmp_dir, "stage"))
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    for _ in range(2):  # foreachBatch may call again for the same id
        assert csv_ingest.load_batch(batch, 0, target, "t") == 2
    assert csv_ingest.load_batch(batch, 1, target, "t") == 2
    assert target.read(spark, "t").count() == 4
