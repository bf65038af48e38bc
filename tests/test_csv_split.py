"""S5 in byte ranges: any division of a file gives the rows of the whole-file reader."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.session import scratch_path
from rollcall.sources.csv_io import read_export_csv, write_export_csv

SCHEMA = T.StructType([T.StructField("pk", T.LongType()), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())])
TEXTS = ["plain", "", None, 'a "quoted" word', '"', '""', "two\nlines", "\n", "x\n\n\ny;z", ";", "ends with \n", 'breaks "\n" in quotes', "é\nÿ;", "\r\n within", "long " * 40 + "\n" + "long " * 40]


def _local(path: str) -> str:
    return path.removeprefix("file:")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def ranges(spark):
    """Scans in ranges of about ``n`` bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}

    def of(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    for k in keys:
        spark.conf.unset(k)


def _quoted(v) -> str:
    v = "" if v is None else str(v)
    return '"' + v.replace('"', '""') + '"' if any(c in v for c in ';"\n\r') else v


def _write(folder: str, name: str, rows, header: str, end: str = "\n", index: bool = True) -> str:
    import os
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(header + end)
        for i, r in enumerate(rows):
            f.write(";".join(([str(i)] if index else []) + [_quoted(v) for v in r]) + end)
    return path


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_ranges_equal_the_whole_file(spark, ranges, size):
    """Line breaks, doubled quotes and separators fall on the edges of ranges; records span several."""
    rng = random.Random(size)
    folder = _local(scratch_path(spark, "t-split"))
    # the whole-file reader turns \r\n in a value to \n where the file's own lines end so
    texts = [[t for t in TEXTS if t != "\r\n within"], TEXTS]
    files = [[(rng.randrange(10**6), rng.choice(texts[k]), f"{rng.random():.3f}".replace(".", ",")) for _ in range(60)] for k in range(2)]
    for k, rows in enumerate(files):
        _write(folder, f"f{k}.csv", rows, ";pk;name;score", end="\n" if k else "\r\n")
    whole = _rows(read_export_csv(spark, folder, SCHEMA, has_index=True, keep_index=True, source_col="file"))
    ranges(size)
    df = read_export_csv(spark, folder, SCHEMA, has_index=True, keep_index=True, source_col="file", split_bytes=1)
    assert len(whole) == 120 and _rows(df) == whole


def test_one_file_is_many_tasks(spark, ranges):
    rows = [(k, f"name {k}\nsecond line", "1,5") for k in range(20_000)]
    path = _write(_local(scratch_path(spark, "t-split-tasks")), "big.csv", rows, "pk;name;score", index=False)
    ranges(64 << 10)
    df = read_export_csv(spark, path, SCHEMA, split_bytes=1)
    assert df.rdd.getNumPartitions() >= 8
    assert read_export_csv(spark, path, SCHEMA, split_bytes=1 << 30).rdd.getNumPartitions() == 1
    assert df.agg({"pk": "sum", "score": "sum", "name": "count"}).first().asDict() == {"sum(pk)": 199990000, "sum(score)": 30000.0, "count(name)": 20000}


def test_export_round_trip_in_ranges(spark, ranges):
    data = spark.createDataFrame([(k, TEXTS[k % len(TEXTS)] or None, k / 8) for k in range(300)], SCHEMA)
    path = scratch_path(spark, "t-split-export")
    write_export_csv(data, path, index_order=["pk"])
    ranges(100)
    assert _rows(read_export_csv(spark, path, SCHEMA, has_index=None, split_bytes=1)) == _rows(data)


def test_broken_files_are_errors(spark, ranges):
    folder = _local(scratch_path(spark, "t-split-broken"))
    ranges(16)
    path = _write(folder, "open.csv", [(1, "x", "1,0")], "pk;name;score", index=False)
    with open(path, "a", encoding="utf-8") as f:
        f.write('2;"never closed\nand on;1\n')
    with pytest.raises(Exception, match="don't close"):
        read_export_csv(spark, path, SCHEMA, split_bytes=1).collect()
    _write(folder + "/two", "a.csv", [(1, "x", "1,0")], "pk;name;score", index=False)
    _write(folder + "/two", "b.csv", [(1, "x", "1,0")], "pk;score;name", index=False)
    with pytest.raises(Exception, match="another header"):
        read_export_csv(spark, folder + "/two", SCHEMA, split_bytes=1).collect()


def test_many_ranges_without_a_broadcast(spark, ranges, monkeypatch):
    from rollcall.sources import csv_split
    rows = [(k, TEXTS[k % len(TEXTS)], "0,5") for k in range(100)]
    path = _write(_local(scratch_path(spark, "t-split-sorted")), "f.csv", rows, "pk;name;score", index=False)
    expected = _rows(read_export_csv(spark, path, SCHEMA))
    ranges(50)
    monkeypatch.setattr(csv_split.split_records, "__defaults__", ('"', 0))
    assert _rows(read_export_csv(spark, path, SCHEMA, split_bytes=1)) == expected


def test_small_ranges_share_tasks(spark, ranges):
    """Tasks are counted by bytes and cores, not by ranges, and a range stays whole in one task."""
    from rollcall.sources import csv_split
    rows = [(k, f"name {k}\nsecond line" if k % 3 else None, "1,5") for k in range(10_000)]
    path = _write(_local(scratch_path(spark, "t-split-shared")), "f.csv", rows, "pk;name;score", index=False)
    expected = _rows(read_export_csv(spark, path, SCHEMA))
    ranges(1 << 10)
    most = 8 * spark.sparkContext.defaultParallelism
    lines = csv_split._lines(spark, [path])
    tasks = lines.select("start", F.spark_partition_id().alias("task")).distinct().groupBy("start").count()
    assert tasks.count() > 5 * most and tasks.where("count > 1").isEmpty()
    df = read_export_csv(spark, path, SCHEMA, split_bytes=1)
    # the pieces at the edges of ranges come back from a shuffle
    assert df.rdd.getNumPartitions() <= most + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _rows(df) == expected


def test_a_task_reads_about_so_many_bytes(spark, ranges, monkeypatch):
    from rollcall.sources import csv_split
    rows = [(k, TEXTS[k % len(TEXTS)], "0,5") for k in range(2000)]
    path = _write(_local(scratch_path(spark, "t-split-bytes")), "f.csv", rows, "pk;name;score", index=False)
    expected = _rows(read_export_csv(spark, path, SCHEMA))
    ranges(512)
    monkeypatch.setattr(csv_split, "TASK_BYTES", 2048)
    monkeypatch.setattr(csv_split, "TASKS_PER_CORE", 1)
    lines = csv_split._lines(spark, [path])
    tasks = lines.select(F.spark_partition_id().alias("task"), "start").distinct().groupBy("task").count()
    assert tasks.count() > 4 * spark.sparkContext.defaultParallelism  # more bytes, more tasks
    assert tasks.agg(F.max("count")).first()[0] <= 5
    assert _rows(read_export_csv(spark, path, SCHEMA, split_bytes=1)) == expected
