"""Session settings, size-checked broadcasts, the export format and time zones."""

import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import session as S
from rollcall.functions.times import to_local, utc_wall
from rollcall.schemas import POSTS
from rollcall.sources import csv_io as IO
from rollcall.sources.flatten import flatten_posts
from rollcall.plans import standins as X

SHOW = ("from rollcall.session import build_session; s = build_session(); c = s.sparkContext.getConf(); "
        "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), c.get('spark.driver.memory'))")


@pytest.mark.parametrize("args, got", [
    ("--master local[2] --conf spark.sql.shuffle.partitions=64 --driver-memory 900m", "local[2] 64 900m"),
    ("", "local[3] 3 16g"),
])
def test_submitted_settings_survive(args, got, monkeypatch):
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", f"{args} pyspark-shell")
    monkeypatch.setenv("BENCH_CPUS", "3")
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    done = subprocess.run([sys.executable, "-c", SHOW], capture_output=True, text=True, timeout=120, check=False)
    assert f"GOT {got}" in done.stdout, done.stderr[-500:]


class _Session:
    """Stands for a session on a cluster without a checkpoint folder."""

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class conf:
        @staticmethod
        def get(key):
            raise KeyError(key)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_checkpoint_folder_is_an_error(master, monkeypatch):
    monkeypatch.setattr(_Session.sparkContext, "master", master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(_Session)


def test_wide_rows_are_not_broadcast(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 10_000).alias("t"), F.array(F.struct(F.lit("a").alias("s"))).alias("l"))
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(S.bounded_broadcast(df))
    assert not hinted(S.bounded_broadcast(df, max_bytes=50_000))


def test_floats_are_written_as_pandas_does(spark, tmp_path):
    values = [m * 10.0**e for e in range(-9, 16) for m in (1, 1.5, 1.2345678, 9.87654321, 5)] + [0.0, -0.5, 12345678.5, 123456789012345.6, -2e-7, 1e16, 2.5e17]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.v for r in IO._decimal_comma(df).collect()}
    path = tmp_path / "x.csv"
    pd.DataFrame({"v": values}).to_csv(path, sep=";", decimal=",", index=False)
    want = path.read_text().split("\n")[1:-1]
    assert [got[i] for i in range(len(values))] == want


def test_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("full_name;username\nAnn;a\n")
    schema = T.StructType([T.StructField("username", T.StringType()), T.StructField("full_name", T.StringType())])
    assert IO.read_export_csv(spark, str(tmp_path / "x.csv"), schema).first() == ("a", "Ann")
    with pytest.raises(ValueError, match="expected"):
        IO.read_export_csv(spark, str(tmp_path / "x.csv"), T.StructType(schema.fields[:1]))


def test_flattened_posts_round_trip(spark):
    posts = flatten_posts(X.raw_posts(spark, "/root/testdata/sf0.001"))
    posts = posts.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in ("caption_text", "hashtags", "repost")})
    path = S.scratch_path(spark, "t-posts-csv")
    IO.write_export_csv(posts, path)
    back = IO.read_export_csv(spark, path, POSTS)
    assert back.exceptAll(posts).count() == 0 and posts.exceptAll(back).count() == 0


def test_index_starts_again_in_each_folder_of_several_files(spark):
    import os
    path = S.scratch_path(spark, "t-folders")
    df = spark.range(5000).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("snapshot"), "id")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # as where each folder holds more than a partition's worth
    try:
        IO.write_export_csv(df, path, index_order=["id"], folder_per="snapshot")
    finally:
        spark.conf.unset(setting)
    local = path.removeprefix("file:")
    files = {d: [f for f in os.listdir(f"{local}/{d}") if f.endswith(".csv")] for d in os.listdir(local) if d.startswith("snapshot=")}
    assert len(files) == 3 and max(len(f) for f in files.values()) > 1
    rows = IO.read_export_csv(spark, path, T.StructType([T.StructField("id", T.LongType())]), has_index=True, keep_index=True, source_col="f")
    places = rows.groupBy(F.regexp_extract("f", "snapshot=([^/]*)", 1).alias("s")).agg(
        F.min(F.col(IO.INDEX_COL).cast("long")).alias("a"), F.max(F.col(IO.INDEX_COL).cast("long")).alias("b"), F.count("*").alias("n"))
    assert all(r.a == 0 and r.b == r.n - 1 for r in places.collect())


def test_instants_keep_the_hour_that_the_session_zone_repeats(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(8).select("id", F.timestamp_micros((F.lit(X.REPEATED_HOUR) + 12_000 + F.col("id") * 1800) * 1_000_000 + 7).alias("at"))
    want = [(r.utc, r.local) for r in df.orderBy("id").select(utc_wall(df, "at").alias("utc"), to_local(utc_wall(df, "at")).alias("local")).collect()]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = [(r.utc, r.local) for r in df.orderBy("id").select(utc_wall(df, "at").alias("utc"), to_local(utc_wall(df, "at")).alias("local")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == want
    assert len({u for u, _ in got}) == 8 and len({v for _, v in got}) < 8  # the local hour repeats, the instant doesn't
