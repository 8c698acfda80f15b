"""The export data source: ranges, headers, odd files, streams."""

import os

import pytest
from pyspark.sql import functions as F

from senslake.sinks.files import write_archives, write_named
from senslake.sources import csv_export as C
from senslake.sources import exports as E

HEAD = "Date (UTC+05:30),AQS,PM2.5 (µg/m³),User Notes"


def put(folder, name, data):
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def body(n, note="a, b"):
    return "".join(f"2024-01-01 00:00:{i % 60:02d},{i},{i / 2},{note * (i % 5)}µ\n" for i in range(n))


@pytest.mark.parametrize("width", [13, 64, E.RANGE])
def test_every_line_once_whatever_the_range(spark, tmp_dir, width):
    put(tmp_dir, "A.csv", "﻿" + HEAD + "\r\n" + body(20).replace("\n", "\r\n"))
    put(tmp_dir, "B.csv", "\n  \n" + HEAD + "\n\n" + body(11)[:-1])
    put(tmp_dir, "C.csv", "no header\n" + body(3))
    put(tmp_dir, "D.csv", "")
    put(tmp_dir, "E.csv", " \n\n")
    put(tmp_dir, "F.csv", HEAD)
    put(tmp_dir, "notes.txt", body(2))
    put(tmp_dir, ".hidden.csv", body(2))
    got = E.scan(spark, tmp_dir, width)
    rows = {(r["file_name"], r["position"]): (r["header_line"], r["line"]) for r in got.collect()}
    assert got.count() == len(rows) == 20 + 11 + 4 + 2
    for name, head in (("A.csv", HEAD), ("B.csv", HEAD), ("C.csv", None)):
        with open(f"{tmp_dir}/{name}", "rb") as f:
            data = f.read()
        want, at = {}, 0
        for raw in data.split(b"\n"):
            line = raw.rstrip(b"\r").decode().removeprefix("﻿")
            if line.strip() and line != HEAD:
                want[name, at] = (head, line)
            at += len(raw) + 1
        assert {k: v for k, v in rows.items() if k[0] == name} == want
    assert rows["D.csv", 0] == rows["E.csv", 0] == (None, None)
    assert sorted(r["file_name"] for r in E.rejected(got).collect()) == ["C.csv", "D.csv", "E.csv"]


def test_rows_equal_the_joined_reader(spark, tmp_dir):
    put(tmp_dir, "A.csv", "﻿" + HEAD + "\n" + body(50) + "2024-01-01 01:00:00,short\n" + HEAD + "\n")
    put(tmp_dir, "B.csv", "AQS, Date (UTC-03:00),User Notes\n5,2024-01-01 00:00:00,quoting Date (UTC here, and there\n")
    cols = ["file_name", "header", "date_idx", "offset_min", "cells", "n_found"]
    a = E.rows(E.scan(spark, tmp_dir, 100)).select(*cols)
    b = C.split_rows(C.read_lines(spark, f"{tmp_dir}/*.csv")).select(*cols)
    assert a.count() == 52 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert C.to_records(E.rows(E.scan(spark, tmp_dir))).where("recorded_at IS NULL").count() == 0


def test_backfill_maps_files_to_devices(spark, tmp_dir):
    put(tmp_dir, "aabbccddeeff_01-Jan-2024.csv", HEAD + "\n" + body(3))
    put(tmp_dir, "000000000000_x.csv", HEAD + "\n" + body(2))
    put(tmp_dir, "export_1.csv", HEAD + "\n" + body(4))
    macs = spark.createDataFrame([("AABBCCDDEEFF", 7)], "mac string, device_id long")
    got = E.backfill(E.scan(spark, tmp_dir), macs)
    assert sorted((r["mac"], r["device_id"], r["count"]) for r in got.groupBy("mac", "device_id").count().collect()) == [("000000000000", None, 2), ("AABBCCDDEEFF", 7, 3)]


def test_one_file_spreads_over_partitions(spark, tmp_dir):
    put(tmp_dir, "A.csv", HEAD + "\n" + body(2000))
    assert E.scan(spark, tmp_dir, 10_000).rdd.getNumPartitions() == -(-os.path.getsize(f"{tmp_dir}/A.csv") // 10_000)
    assert E.scan(spark, f"{tmp_dir}/A.csv").count() == 2000


def test_line_longer_than_a_read(spark, tmp_dir):
    put(tmp_dir, "A.csv", HEAD + "\n" + f"2024-01-01 00:00:00,1,2,{'x' * (3 * E.READ)}\n" + body(2))
    got = E.scan(spark, tmp_dir, 1 << 20).select("position", F.length("line").alias("n")).orderBy("position").collect()
    assert len(got) == 3 and got[0]["n"] == 3 * E.READ + 24


def test_empty_folder_and_missing_one(spark, tmp_dir):
    assert E.scan(spark, tmp_dir).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        E.scan(spark, f"{tmp_dir}/nowhere").count()


def test_stream_takes_each_file_once_over_restarts(spark, tmp_dir):
    land, log, out, ckpt = (f"{tmp_dir}/{x}" for x in ("land", "log", "out", "ckpt"))
    os.mkdir(land)
    for n, name in enumerate(("M.csv", "A.csv", "Z.csv")):
        put(land, name, HEAD + "\n" + body(10 + n))
        os.utime(f"{land}/{name}", (1000 - n, 1000 - n))  # later files look older
        q = (E.stream(spark, land, log, 100).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(once=True).start())
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.exceptAll(E.scan(spark, land)).count() == 0 and got.count() == 33
    assert sorted(os.listdir(log)) == ["1.json", "2.json", "3.json"]


def test_written_files_are_read_back(spark, tmp_dir):
    files = spark.createDataFrame([(f"F{i}.csv", HEAD + "\n" + body(i)) for i in range(30)] + [("none.csv", None)], "file_name string, content string").repartition(4)
    assert write_named(files, f"file:{tmp_dir}/x") == 31 and write_named(files, f"{tmp_dir}/x") == 31
    assert sorted(os.listdir(f"{tmp_dir}/x")) == sorted([f"F{i}.csv" for i in range(30)] + ["none.csv"])
    assert E.scan(spark, f"file://{tmp_dir}/x").where("line IS NOT NULL").count() == sum(range(30))


def test_many_short_files_come_in_archives(spark, tmp_dir):
    files = spark.createDataFrame([(f"F{i}.csv", "\ufeff" + HEAD + "\r\n" + body(i % 3)) for i in range(3000)] + [("none.csv", None), (".hidden.csv", body(1)), ("x" * 150 + ".csv", "no header\n")],
                                  "file_name string, content string").repartition(3)
    n = write_archives(files, f"{tmp_dir}/a", 200_000)
    assert 3 < n == len([f for f in os.listdir(f"{tmp_dir}/a") if f.endswith(".tar")]) < 60
    write_named(files, f"{tmp_dir}/b")
    got, want = E.scan(spark, f"{tmp_dir}/a"), E.scan(spark, f"{tmp_dir}/b")
    assert got.count() == 3002 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.rdd.getNumPartitions() == 1 and want.rdd.getNumPartitions() <= 4
    assert len(list(E.ExportReader({"path": f"{tmp_dir}/b"}).read(E.FileRanges([(f"{tmp_dir}/b/F2.csv", 0, 1000)] * 50)))) == 1  # lines of many files in one batch
    q = E.stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/log").writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt")
    q.trigger(once=True).start().awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").exceptAll(want).count() == 0
