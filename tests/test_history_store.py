"""Daily apply against a pk-bucketed open set: same history, only the snapshot shuffles."""

import datetime as dt
import os
import re

import pytest

from rollcall.operators.history import apply_snapshot_split, dedupe_snapshot
from rollcall.schemas import FOLLOWERS
from rollcall.session import scratch_path
from rollcall.sources.history_store import apply_daily, exists, read_open, read_store, seed_store
from tests.test_history import EXPECTED, STEPS, _as_map, _snap


def test_daily_runs_equal_the_fold(spark):
    root = scratch_path(spark, "t-store")
    for version, (ts, rows) in enumerate(STEPS):
        apply_daily(spark, root, _snap(spark, ts, rows), ts.date(), version)
    assert _as_map(read_store(spark, root, len(STEPS) - 1)) == EXPECTED


def test_bucketed_open_set_is_not_shuffled(spark):
    root = scratch_path(spark, "t-store-plan")
    ts, rows = STEPS[0]
    apply_daily(spark, root, _snap(spark, ts, rows), ts.date(), 0)  # buckets = shuffle partitions
    opened = read_open(spark, root, 0)
    ts, rows = STEPS[1]
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:  # as at scale: both sides too big to broadcast
        spark.conf.set(k, "-1")
    try:
        out = apply_snapshot_split(opened, dedupe_snapshot(_snap(spark, ts, rows)), ts.date())
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(keys[0])
        spark.conf.unset(keys[1])
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in final and "Bucketed: true" in final
    assert len(re.findall(r"Exchange hashpartitioning\(pk", final)) == 1  # the snapshot side only


def test_partition_setting_may_change_between_runs(spark):
    root = scratch_path(spark, "t-store-parts")
    people = [(k, f"u{k}", None, d, None, d, None) for d in [dt.date(2024, 1, 1)] for k in range(1000)]
    seed_store(spark, root, spark.createDataFrame(people, FOLLOWERS), buckets=8)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    try:
        for version, parts in ((1, "4"), (2, "16")):
            spark.conf.set(setting, parts)
            ts = dt.datetime(2024, 1, 1 + version, 9)
            apply_daily(spark, root, _snap(spark, ts, [(k, f"u{k}", None) for k in range(900)]), ts.date(), version)
            rows = read_store(spark, root, version).collect()
            assert len(rows) == 1000 and sum(r.data_saida is None for r in rows) == 900
            assert {r.data_entrada for r in rows} == {dt.date(2024, 1, 1)}
    finally:
        spark.conf.set(setting, before)


def test_stores_of_one_folder_name_stay_apart(spark):
    roots = [scratch_path(spark, f"t-store-{n}") + "/it's a store" for n in ("a", "b")]
    for root, n in zip(roots, (10, 20), strict=True):
        day = dt.date(2024, 1, 1)
        seed_store(spark, root, spark.createDataFrame([(k, "u", None, day, None, day, None) for k in range(n)], FOLLOWERS))
    assert [read_store(spark, r, 0).count() for r in roots] == [10, 20]


def test_unreadable_closed_periods_are_an_error(spark):
    root = scratch_path(spark, "t-store-closed")
    day = dt.date(2024, 1, 1)
    seed_store(spark, root, spark.createDataFrame([(1, "u", None, day, day, day, None)], FOLLOWERS))
    assert read_store(spark, root, 0).count() == 1
    folder = root.removeprefix("file:") + "/closed/run=0"
    folder += "/" + os.listdir(folder)[0]
    for name in os.listdir(folder):
        if name.startswith("part-"):
            with open(f"{folder}/{name}", "wb") as fh:
                fh.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|crc|checksum"):
        read_store(spark, root, 0).collect()
    assert exists(spark, root)
