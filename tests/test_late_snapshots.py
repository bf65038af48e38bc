"""K7 out of order: snapshots older than the store's last one are worked in where they belong."""

import datetime as dt
import random
import re

import pytest

from rollcall.operators.history import apply_snapshot, late_changes
from rollcall.schemas import FOLLOWERS, empty
from rollcall.session import scratch_path
from rollcall.sources.history_store import apply_daily, committed_versions, meta, read_closed, read_open, read_store, seed_store
from tests.test_history import _snap

DAY = dt.date(2024, 3, 1)


def _day(k: int) -> dt.date:
    return DAY + dt.timedelta(days=k)


def _snaps(days: int, people: int, seed: int) -> list[list[tuple]]:
    """Per day (pk, username, full_name); names change by day, a pk may be listed twice or be null, one day is empty."""
    rng = random.Random(seed)
    out = []
    for d in range(days):
        rows = [(pk, f"u{pk}.{d}", None if rng.random() < 0.2 else f"n{d}") for pk in range(people) if rng.random() < 0.6]
        out.append([] if d == 2 else [*rows, *rows[:1], (None, "nobody", None)])
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.select(*FOLLOWERS.fieldNames()).collect()), key=str)


def _fold(spark, snaps, first=0):
    history = empty(spark, FOLLOWERS)
    for d, rows in enumerate(snaps):
        history = apply_snapshot(history, _snap(spark, dt.datetime.combine(_day(d), dt.time()), rows), _day(d)).checkpoint()
    return history


@pytest.mark.parametrize("seed", [2])
def test_any_order_gives_the_fold(spark, seed):
    """All snapshots of an unseeded store, also one older than all, in a random order."""
    snaps = _snaps(6, 12, seed)
    order = list(range(6))
    random.Random(seed).shuffle(order)
    root = scratch_path(spark, "t-late")
    for version, d in enumerate(order):
        apply_daily(spark, root, _snap(spark, dt.datetime.combine(_day(d), dt.time()), snaps[d]), _day(d), version, buckets=2)
    assert _rows(read_store(spark, root, 5)) == _rows(_fold(spark, snaps))
    assert meta(spark, root, 5).last_ts.date() == _day(5)


def test_each_kind_of_presence(spark):
    """Before, late and after: all eight cases, with marks of welcome and periods that go on."""
    here = {pk: [bool(pk & 4), bool(pk & 2), bool(pk & 1)] for pk in range(8)}
    snaps = [[(pk, f"{pk}@{k}", None) for pk, seen in here.items() if seen[k]] for k in range(3)]
    near = _fold(spark, [snaps[0], snaps[2]]).collect()  # dates 0 and 1: the late one comes between, so the last is moved
    moved = [r.asDict() | {c: _day(2) if r[c] == _day(1) else r[c] for c in ("data_entrada", "data_saida", "data_update")} for r in near]
    near = spark.createDataFrame([tuple(r[c] for c in FOLLOWERS.fieldNames()) for r in moved], FOLLOWERS)
    day = [_snap(spark, dt.datetime.combine(_day(k), dt.time()), snaps[k]) for k in range(3)]
    changes = late_changes(near.where("data_saida IS NULL"), near.where("data_saida IS NOT NULL"), day[1], _day(1), _day(2), _day(0), day[0]).collect()
    assert {r["pk"] for r in changes} == {5, 6, 4, 3, 2}
    rows = {r["pk"]: [(x["username"], x["data_entrada"], x["data_saida"], x["data_update"]) for x in r["rows"]] for r in changes}
    a, b, c = _day(0), _day(1), _day(2)
    assert rows == {5: [("5@0", a, b, a), ("5@2", c, None, c)], 6: [("6@1", a, c, b)], 4: [("4@0", a, b, a)], 3: [("3@2", b, None, c)], 2: [("2@1", b, c, b)]}


def test_what_cannot_be_worked_in_is_refused(spark):
    root = scratch_path(spark, "t-late-refused")
    seed_store(spark, root, _fold(spark, _snaps(2, 5, 3)), buckets=2)
    some = _snap(spark, dt.datetime.combine(DAY, dt.time()), [(1, "a", None)])
    apply_daily(spark, root, some, _day(4), 1)
    with pytest.raises(ValueError, match="seeded"):
        apply_daily(spark, root, some, _day(0) - dt.timedelta(days=1), 2)
    apply_daily(spark, root, some, _day(6), 2)
    with pytest.raises(ValueError, match="has a snapshot"):
        apply_daily(spark, root, some, _day(4), 3)
    assert committed_versions(spark, root) == [0, 1, 2]
    apply_daily(spark, root, some, _day(5), 3)
    assert [r["data_saida"] for r in read_store(spark, root, 3).where("pk = 1").collect()].count(None) == 1


def test_late_run_reads_what_it_touches(spark):
    """Closed periods are cut by date in the scan, and the open set isn't shuffled."""
    root = scratch_path(spark, "t-late-plan")
    for version, d in enumerate((0, 1, 4)):
        apply_daily(spark, root, _snap(spark, dt.datetime.combine(_day(d), dt.time()), [(k, "u", None) for k in range(50 - 10 * d)]), _day(d), version, buckets=8)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        closed = read_closed(spark, root, 2).where(f"data_saida >= date'{_day(4)}' and data_entrada <= date'{_day(4)}'")
        out = late_changes(read_open(spark, root, 2), closed, _snap(spark, dt.datetime.combine(_day(2), dt.time()), [(k, "u", None) for k in range(30)]), _day(2), _day(4), _day(1), None)
        out.collect()
        execution = out._jdf.queryExecution()
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(execution, "formatted")
        tree = execution.executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "GreaterThanOrEqual(data_saida" in plan and "LessThanOrEqual(data_entrada" in plan
    assert "Bucketed: true" in plan
    # what stands between the join and the scan of the open set moves no rows
    scan = next(i for i, line in enumerate(tree) if "history_open_" in line)
    join = max(i for i in range(scan) if "SortMergeJoin" in tree[i])
    assert not any("Exchange" in line or "ShuffleQueryStage" in line for line in tree[join:scan])


def test_closed_periods_replaced_are_read_once(spark):
    """A period changed twice by late snapshots is there once, and earlier versions read as they were."""
    root = scratch_path(spark, "t-late-twice")
    seen = _snap(spark, dt.datetime.combine(DAY, dt.time()), [(1, "a", None)])
    none = seen.where("false")
    for version, (d, snap) in enumerate([(0, seen), (9, none), (5, none), (3, none), (2, seen)]):
        apply_daily(spark, root, snap, _day(d), version, buckets=2)
    ends = [[r["data_saida"] for r in read_store(spark, root, v).collect()] for v in range(5)]
    assert ends == [[None], [_day(9)], [_day(5)], [_day(3)], [_day(3)]]


def test_of_two_runs_one_is_committed(spark, monkeypatch):
    """Both start from run 0; the second to end is refused, and nothing of it is read."""
    from rollcall.sources import history_store, marks

    root = scratch_path(spark, "t-two-runs")
    snap = _snap(spark, dt.datetime.combine(DAY, dt.time()), [(1, "a", None), (2, "b", None)])
    apply_daily(spark, root, snap, _day(0), 0)
    put, entered = marks.put, []

    def late(spark, root, number, content):
        if not entered:
            entered.append(True)
            apply_daily(spark, root, snap.where("pk = 1"), _day(1), 1)
        put(spark, root, number, content)

    monkeypatch.setattr(history_store.marks, "put", late)
    with pytest.raises(marks.Conflict):
        apply_daily(spark, root, snap.where("pk = 2"), _day(1), 1)
    assert {r.pk: r.data_saida for r in read_store(spark, root, 1).collect()} == {1: None, 2: _day(1)}
