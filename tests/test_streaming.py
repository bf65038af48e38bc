"""Snapshot files as a stream: micro-batches extend the stored history like one replay."""

import os
import tempfile

from rollcall.session import scratch_path
from rollcall.streaming import read_history, snapshot_stream
from tests.test_history import EXPECTED, STEPS, _as_map


def _write_snapshots(folder):
    for i, (ts, rows) in enumerate(STEPS):
        name = f"{folder}/df_followers_{ts:%Y-%m-%d %H%M%S}.csv"
        with open(name, "w", encoding="utf-8") as fh:
            fh.write(";pk;username;full_name\n")
            for j, (pk, u, f) in enumerate(rows):
                fh.write(f"{j};{pk};{u};{f}\n")
        os.utime(name, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))  # arrival order
    with open(f"{folder}/df_followings_2024-01-01 090000.csv", "w") as fh:
        fh.write(";pk;username;full_name\n0;9;z;Z\n")


def test_stream_of_snapshot_files_equals_replay(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-stream-")
    _write_snapshots(folder)
    root = scratch_path(spark, "t-hist")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    q = snapshot_stream(spark, folder, root, ckpt, max_files_per_trigger=2)
    q.awaitTermination(300)
    assert q.exception() is None
    assert _as_map(read_history(spark, root)) == EXPECTED
    # a second run over the same checkpoint finds nothing new and changes nothing
    q2 = snapshot_stream(spark, folder, root, ckpt, max_files_per_trigger=2)
    q2.awaitTermination(300)
    assert _as_map(read_history(spark, root)) == EXPECTED


def _history_of(spark, folder, per_trigger):
    root = scratch_path(spark, "t-hist-any")
    q = snapshot_stream(spark, folder, root, scratch_path(spark, "t-ckpt-any"), max_files_per_trigger=per_trigger)
    q.awaitTermination(300)
    assert q.exception() is None
    return root


def test_files_may_arrive_in_any_order_and_few_at_a_time(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-stream-late-")
    _write_snapshots(folder)
    names = sorted(n for n in os.listdir(folder) if n.startswith("df_followers"))
    for i, name in enumerate(names):  # the latest snapshot arrives first
        os.utime(f"{folder}/{name}", (1_700_000_000 - i * 60, 1_700_000_000 - i * 60))
    assert _as_map(read_history(spark, _history_of(spark, folder, 1))) == EXPECTED
    assert _as_map(read_history(spark, _history_of(spark, folder, 3))) == EXPECTED


def test_names_with_a_date_only_count_at_midnight(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-stream-date-")
    _write_snapshots(folder)
    for name in sorted(os.listdir(folder)):
        if name.startswith("df_followers") and "2024-01-04" not in name:
            os.rename(f"{folder}/{name}", f"{folder}/{name[:23]}.csv")
    assert _as_map(read_history(spark, _history_of(spark, folder, 2))) == EXPECTED


def test_first_row_of_a_repeated_pk_names_it(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-stream-dup-")
    with open(f"{folder}/df_followers_2024-01-01 090000.csv", "w") as fh:
        fh.write(";pk;username;full_name\n0;1;zed;Z\n1;1;abe;A\n")
    rows = read_history(spark, _history_of(spark, folder, 5)).collect()
    assert [(r.pk, r.username) for r in rows] == [(1, "zed")]


def test_a_late_file_keeps_marks_and_a_seeded_store_refuses_it(spark):
    import pytest

    from rollcall.sources.history_store import committed_versions, mark_store, seed_store
    from rollcall.streaming import apply_files
    folder = tempfile.mkdtemp(prefix="rollcall-stream-marks-")
    for day, rows in ((1, "0;1;a;A\n"), (3, "0;1;a;A\n1;2;b;B\n")):
        with open(f"{folder}/df_followers_2024-01-0{day} 090000.csv", "w") as fh:
            fh.write(";pk;username;full_name\n" + rows)
    root, ckpt = scratch_path(spark, "t-hist-marks"), scratch_path(spark, "t-ckpt-marks")
    snapshot_stream(spark, folder, root, ckpt).awaitTermination(300)
    mark_store(spark, root, spark.createDataFrame([(1,)], "pk long"))
    late = f"{folder}/df_followers_2024-01-02 090000.csv"
    with open(late, "w") as fh:
        fh.write(";pk;username;full_name\n0;1;a;A\n1;2;b;B\n")
    snapshot_stream(spark, folder, root, ckpt).awaitTermination(300)
    rows = {(r.pk, r.data_entrada.day, r.welcome) for r in read_history(spark, root).collect()}
    assert rows == {(1, 1, 1), (2, 2, None)}

    seeded = scratch_path(spark, "t-hist-seeded")
    seed_store(spark, seeded, read_history(spark, root))
    with pytest.raises(ValueError, match="2024-01-02"):
        apply_files(spark, spark.createDataFrame([(late,)], "path string"), seeded, 0)
    assert committed_versions(spark, seeded) == [0]


def test_next_batch_reads_the_open_set_in_place(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from rollcall.operators.history import replay_history
    from rollcall.schemas import SNAPSHOT
    from rollcall.sources.history_store import committed_versions, meta, read_open
    folder = tempfile.mkdtemp(prefix="rollcall-stream-plan-")
    _write_snapshots(folder)
    root = scratch_path(spark, "t-hist-plan")
    snapshot_stream(spark, folder, root, scratch_path(spark, "t-ckpt-plan")).awaitTermination(300)
    last = committed_versions(spark, root)[-1]
    buckets, opened = meta(spark, root, last).buckets, read_open(spark, root, last)
    ts = dt.datetime(2024, 1, 5, 9)
    rows = spark.createDataFrame([(ts, 2, "b", "B"), (ts, 5, "e", None)], SNAPSHOT)
    cat = rows.select("snap_ts", F.to_date("snap_ts").alias("snap_date")).distinct()
    for k in ("spark.sql.autoBroadcastJoinThreshold",):
        spark.conf.set(k, "-1")
    try:
        out = replay_history(rows, cat, initial=opened, partitions=buckets)
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in final  # the stored open set keeps its layout: no shuffle of it
