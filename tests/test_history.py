"""K7 apply / K8 replay: golden steps (FIXTURES.md §2) and replay = fold on random cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.history import (
    HISTORY_COLS, apply_snapshot, clean_snapshot, present_in, replay_history,
)
from rollcall.schemas import FOLLOWERS, SNAPSHOT, empty

D = dt.date
CAT = T.StructType([T.StructField("snap_ts", T.TimestampNTZType()), T.StructField("snap_date", T.DateType())])

# (snapshot time, rows)
STEPS = [
    (dt.datetime(2024, 1, 1, 9), [(1, "a", "A"), (2, "b", "B")]),
    (dt.datetime(2024, 1, 2, 9), [(1, "a2", "A"), (3, "c", "C")]),
    (dt.datetime(2024, 1, 3, 9), []),
    (dt.datetime(2024, 1, 4, 9), [(2, "b", "B")]),
    (dt.datetime(2024, 1, 4, 18), []),
]

EXPECTED = {
    (1, D(2024, 1, 1)): ("a2", "A", D(2024, 1, 3), D(2024, 1, 2)),
    (2, D(2024, 1, 1)): ("b", "B", D(2024, 1, 2), D(2024, 1, 1)),
    (3, D(2024, 1, 2)): ("c", "C", D(2024, 1, 3), D(2024, 1, 2)),
    (2, D(2024, 1, 4)): ("b", "B", D(2024, 1, 4), D(2024, 1, 4)),
}


def _snap(spark, ts, rows):
    return spark.createDataFrame([(ts, pk, u, f) for pk, u, f in rows], SNAPSHOT)


def _as_map(df):
    return {(r.pk, r.data_entrada): (r.username, r.full_name, r.data_saida, r.data_update)
            for r in df.collect()}


def test_apply_snapshot_steps(spark):
    hist = empty(spark, FOLLOWERS)
    for i, (ts, rows) in enumerate(STEPS):
        hist = apply_snapshot(hist, _snap(spark, ts, rows), ts.date()).checkpoint()
        if i == 1:
            m = _as_map(hist)
            assert m[(1, D(2024, 1, 1))] == ("a2", "A", None, D(2024, 1, 2))
            assert m[(2, D(2024, 1, 1))] == ("b", "B", D(2024, 1, 2), D(2024, 1, 1))
            assert m[(3, D(2024, 1, 2))] == ("c", "C", None, D(2024, 1, 2))
        if i == 3:
            assert _as_map(hist)[(2, D(2024, 1, 4))] == ("b", "B", None, D(2024, 1, 4))
    assert _as_map(hist) == EXPECTED
    assert hist.columns == HISTORY_COLS


def test_replay_equals_steps_with_empty_snapshots_from_catalogue(spark):
    rows = [(ts, pk, u, f) for ts, snap in STEPS for pk, u, f in snap]
    snaps = spark.createDataFrame(rows, SNAPSHOT)
    catalog = spark.createDataFrame([(ts, ts.date()) for ts, _ in STEPS], CAT)
    assert _as_map(replay_history(snaps, catalog)) == EXPECTED


def test_null_pk_rejected_and_counted(spark):
    snap = _snap(spark, dt.datetime(2024, 1, 1), [(1, "a", None), (None, "x", None)])
    good, bad = clean_snapshot(snap)
    assert good.count() == 1 and bad.count() == 1
    hist = apply_snapshot(empty(spark, FOLLOWERS), snap, D(2024, 1, 1))
    assert [r.pk for r in hist.collect()] == [1]


def test_welcome_survives_and_present_in(spark):
    hist = spark.createDataFrame(
        [(1, "a", None, D(2024, 1, 1), None, D(2024, 1, 1), 1),
         (2, "b", None, D(2024, 1, 1), None, D(2024, 1, 1), None)], FOLLOWERS)
    snap = _snap(spark, dt.datetime(2024, 1, 2), [(1, "a", "Full")])
    out = {r.pk: r for r in apply_snapshot(hist, snap, "2024-01-02").collect()}
    assert out[1].welcome == 1 and out[1].full_name == "Full" and out[1].data_saida is None
    assert out[2].data_saida == D(2024, 1, 2)
    assert [r.pk for r in present_in(hist, snap).collect()] == [1]


def fold_py(steps):
    """Brute force: the three statements of one apply, run in order for each snapshot."""
    hist = []  # dicts
    for ts, rows in steps:
        d = ts.date()
        snap = {}
        for pk, u, f in rows:
            snap.setdefault(pk, (u, f))  # first row of a pk wins
        for h in hist:
            if h["data_saida"] is None and h["pk"] not in snap:
                h["data_saida"] = d
        open_pks = {h["pk"] for h in hist if h["data_saida"] is None}
        for pk, (u, f) in snap.items():
            if pk not in open_pks:
                hist.append(dict(pk=pk, username=u, full_name=f, data_entrada=d, data_saida=None,
                                 data_update=None))
        for h in hist:
            if h["data_saida"] is None and h["pk"] in snap:
                h["username"], h["full_name"] = snap[h["pk"]]
                h["data_update"] = d
    return {(h["pk"], h["data_entrada"]): (h["username"], h["full_name"], h["data_saida"], h["data_update"])
            for h in hist}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_fold_random(spark, seed):
    rnd = random.Random(seed)
    t = dt.datetime(2024, 1, 1, 8)
    steps = []
    for _ in range(25):
        t += dt.timedelta(hours=13)
        if rnd.random() < 0.1:
            rows = []
        else:
            rows = [(pk, f"u{pk}_{rnd.randint(0, 2)}", rnd.choice([None, f"F{pk}"]))
                    for pk in range(40) if rnd.random() < 0.6]
        steps.append((t, rows))
    rows = [(ts, pk, u, f) for ts, snap in steps for pk, u, f in snap]
    snaps = spark.createDataFrame(rows, SNAPSHOT)
    catalog = spark.createDataFrame([(ts, ts.date()) for ts, _ in steps], CAT)
    assert _as_map(replay_history(snaps, catalog)) == fold_py(steps)


def test_apply_chain_equals_fold(spark):
    rnd = random.Random(7)
    t = dt.datetime(2024, 2, 1)
    steps = []
    for i in range(6):
        t += dt.timedelta(hours=13)
        rows = [] if i == 3 else [(pk, f"u{pk}_{i % 2}", None) for pk in range(12) if rnd.random() < 0.5]
        steps.append((t, rows))
    hist = empty(spark, FOLLOWERS)
    for ts, rows in steps:
        hist = apply_snapshot(hist, _snap(spark, ts, rows), ts.date()).checkpoint()
    assert _as_map(hist) == fold_py(steps)


def test_replay_continues_from_a_history(spark):
    rnd = random.Random(11)
    t = dt.datetime(2024, 3, 1)
    steps = []
    for i in range(10):
        t += dt.timedelta(hours=13)
        rows = [] if i == 6 else [(pk, f"u{pk}_{rnd.randint(0, 1)}", None) for pk in range(15)
                                  if rnd.random() < 0.6]
        steps.append((t, rows))
    head, tail = steps[:4], steps[4:]
    start = replay_history(
        spark.createDataFrame([(ts, pk, u, f) for ts, s in head for pk, u, f in s], SNAPSHOT),
        spark.createDataFrame([(ts, ts.date()) for ts, _ in head], CAT))
    start = start.withColumn("welcome", F.when(F.col("pk") % 3 == 0, F.lit(1)).cast("int")).checkpoint()
    cont = replay_history(
        spark.createDataFrame([(ts, pk, u, f) for ts, s in tail for pk, u, f in s], SNAPSHOT),
        spark.createDataFrame([(ts, ts.date()) for ts, _ in tail], CAT), initial=start)
    assert _as_map(cont) == fold_py(steps)
    marked = {(r.pk, r.data_entrada) for r in start.collect() if r.welcome == 1 and r.data_saida is None}
    kept = {(r.pk, r.data_entrada): r.welcome for r in cont.collect()}
    assert marked and all(kept[k] == 1 for k in marked)


def test_replay_plan_broadcasts_the_calendar(spark):
    snaps = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, "a", None)], SNAPSHOT)
    catalog = spark.createDataFrame([(dt.datetime(2024, 1, 1), D(2024, 1, 1))], CAT)
    plan = replay_history(snaps, catalog)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan


@pytest.mark.parametrize("seed", [21, 22])
def test_replay_with_duplicate_pks_first_row_wins(spark, seed):
    rnd = random.Random(seed)
    t = dt.datetime(2024, 4, 1)
    steps, rows = [], []
    for s in range(12):
        t += dt.timedelta(hours=11)
        snap = []
        for pos in range(rnd.randint(0, 25)):
            pk = rnd.randint(0, 9)  # repeats inside one snapshot
            snap.append((pk, f"u{pk}_{s}_{pos}", None))
        steps.append((t, snap))
        rows.extend((t, pk, u, f, pos) for pos, (pk, u, f) in enumerate(snap))
    df = spark.createDataFrame(rows, "snap_ts timestamp_ntz, pk long, username string, full_name string, pos int")
    catalog = spark.createDataFrame([(ts, ts.date()) for ts, _ in steps], CAT)
    assert _as_map(replay_history(df, catalog, order="pos")) == fold_py(steps)
