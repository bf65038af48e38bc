"""Brute-force properties on small random fixtures: D2, K5, K6, K7 duplicates, T5 rejects."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions.scalars import split_rejects, to_pk
from rollcall.operators import accepted_prefix, apply_snapshot, insert_ignore, upsert_replace
from rollcall.schemas import FOLLOWERS, RESULTS, empty


def _prefix_py(rows, include_failing=False):
    out = []
    for run in sorted({r[0] for r in rows}):
        for r in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            if r[3] is False:
                if include_failing:
                    out.append(r)
                break
            out.append(r)
    return sorted(out)


@pytest.mark.parametrize("seed", [3, 4])
def test_accepted_prefix_equals_walk(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"r{rnd.randint(0, 4)}", i, f"u{i}", rnd.choice([True, True, True, None, False]))
            for i in range(300)]
    df = spark.createDataFrame(rows, RESULTS)
    for inc in (False, True):
        got = sorted(tuple(r) for r in accepted_prefix(df, include_failing=inc).collect())
        assert got == _prefix_py(rows, inc)


@pytest.mark.parametrize("seed", [5, 6])
def test_upserts_equal_dict_semantics(spark, seed):
    rnd = random.Random(seed)
    target = {k: (k, f"t{k}", rnd.randint(0, 9)) for k in range(0, 40, 2)}
    batch = [(rnd.randint(0, 50), f"b{i}", i) for i in range(120)]
    tdf = spark.createDataFrame(list(target.values()), "k int, a string, b int")
    bdf = spark.createDataFrame(batch, "k int, a string, o int")
    replaced = dict(target)
    for k, a, _o in batch:                      # INSERT OR REPLACE in batch order
        replaced[k] = (k, a, None)
    got = {r.k: tuple(r) for r in upsert_replace(tdf, bdf, ["k"], ["o"]).collect()}
    assert got == replaced
    ignored = dict(target)
    for k, a, _o in batch:                      # INSERT OR IGNORE in batch order
        ignored.setdefault(k, (k, a, None))
    got = {r.k: tuple(r) for r in insert_ignore(tdf, bdf.withColumnRenamed("o", "ord"), ["k"], ["ord"])
           .collect()}
    assert got == ignored


def test_duplicate_pk_in_snapshot_first_row_wins(spark):
    snap = spark.createDataFrame([(1, "late", None, 2), (1, "early", None, 1), (2, "b", None, 1)],
                                 "pk long, username string, full_name string, pos int")
    out = {r.pk: r for r in apply_snapshot(empty(spark, FOLLOWERS), snap, dt.date(2024, 1, 1), "pos")
           .collect()}
    assert len(out) == 2 and out[1].username == "early"


def test_text_ids_and_rejects(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("x9",), (None,)], "pk string")
    good, bad = split_rejects(df, "pk", to_pk(F.col("pk")))
    assert sorted(r.pk for r in good.collect() if r.pk is not None) == [7, 12]
    assert good.where("pk is null").count() == 1  # a null id is not a reject
    assert [r.pk for r in bad.collect()] == ["x9"]


def test_text_datetimes(spark):
    from rollcall.functions.scalars import to_ts
    df = spark.createDataFrame([("2022-04-25 18:08:49",), ("2022-04-25",), ("nope",), (None,)], "t string")
    got = [r[0] for r in df.select(to_ts(F.col("t"))).collect()]
    assert got == [dt.datetime(2022, 4, 25, 18, 8, 49), dt.datetime(2022, 4, 25), None, None]
