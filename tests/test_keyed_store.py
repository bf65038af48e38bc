"""Stored tables: a batch rewrites the buckets of its keys only, keys are constraints, versions are compare-and-set."""

import os
import random
import tempfile

import pytest

from rollcall.cli import main
from rollcall.schemas import FOLLOWINGS, LIKES, POSTS
from rollcall.session import scratch_path
from rollcall.sources import keyed_store as KS


def _people(spark, rows):
    return spark.createDataFrame(rows, FOLLOWINGS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _files(root):
    root = root.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{root}/data") for f in fs if f.startswith("part-")}


@pytest.fixture()
def store(spark):
    root = scratch_path(spark, "t-keyed")
    KS.create(spark, root, FOLLOWINGS, ["pk"], buckets=8)
    KS.append(spark, root, _people(spark, [(k, f"u{k}", "n") for k in range(200)]))
    return root


def test_random_batches_equal_a_dictionary(spark):
    rng = random.Random(6)
    root, table = scratch_path(spark, "t-keyed-random"), {}
    KS.create(spark, root, LIKES, ["post_pk", "follower_pk"], buckets=4)
    for turn in range(5):
        rows = [(f"p{rng.randrange(6)}", rng.randrange(5), rng.random() < 0.5, f"{turn}.{k:03}") for k in range(40)]
        df = spark.createDataFrame(rows, LIKES)
        if turn % 2:
            KS.insert_ignore(spark, root, df, ["stories"])
            for r in rows:
                table.setdefault(r[:2], r)
        else:
            KS.upsert(spark, root, df.drop("is_private"), ["stories"])
            table |= {r[:2]: (*r[:2], None, r[3]) for r in rows}
        assert _rows(KS.read(spark, root)) == sorted(table.values(), key=str)


def test_untouched_buckets_keep_their_files(spark, store):
    before, files = KS.latest(spark, store), _files(store)
    after = KS.upsert(spark, store, _people(spark, [(7, "new", None), (1007, "newer", None)]), ["username"])
    changed = {b for b in after.parts if after.parts[b] != before.parts.get(b)}
    assert 1 <= len(changed) <= 2 and after.number == before.number + 1
    now = _files(store)
    assert files.items() <= now.items()
    written = {p.split("bucket=")[1].split("/")[0] for p in now.keys() - files.keys()}
    assert written == {str(b) for b in changed}
    added = KS.insert_ignore(spark, store, _people(spark, [(7, "ignored", None), (2007, "added", None)]), ["username"])
    assert {b for b in added.parts if added.parts[b] != after.parts[b]} == {b for b in added.parts if len(added.parts[b]) > 1}
    names = {r.pk: r.username for r in KS.read(spark, store).where("pk in (7, 1007, 2007, 8)").collect()}
    assert names == {7: "new", 1007: "newer", 2007: "added", 8: "u8"}
    # older versions read as they were
    assert KS.read(spark, store, before).count() == 200


def test_the_stored_rows_are_not_shuffled(spark, store):
    v = KS.latest(spark, store)
    new = KS._batch(spark, store, _people(spark, [(7, "new", None)]), v).checkpoint()
    kept = KS.surviving(spark, store, v, new, KS._touched(new))
    assert kept.count() < 60  # one bucket of eight is read
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning" not in plan


def test_keys_are_constraints(spark, store):
    before = KS.latest(spark, store)
    for rows in ([(300, "a", None), (300, "b", None)], [(None, "a", None)], [(5, "stored already", None), (301, "x", None)], [(400, "hot", None)] * 5000):
        with pytest.raises(KS.KeyViolation):
            KS.append(spark, store, _people(spark, rows))
    with pytest.raises(KS.KeyViolation, match="1 keys repeated, 0 null"):
        KS.replace(spark, store, _people(spark, [(1, "a", None), (1, "b", None), (2, "c", None)]))
    with pytest.raises(KS.KeyViolation, match="null"):
        KS.upsert(spark, store, _people(spark, [(None, "a", None)]), ["username"])
    assert KS.latest(spark, store) == before and KS.read(spark, store).count() == 200


def test_of_two_writers_one_wins(spark, store, monkeypatch):
    """Both start from one version; the later commit is refused, and can be run again."""
    write, entered = KS._write, []

    def slow(spark, root, *args, **kw):
        out = write(spark, root, *args, **kw)
        if not entered:
            entered.append(True)
            KS.upsert(spark, root, _people(spark, [(7, "other run", None)]), ["username"])
        return out

    monkeypatch.setattr(KS, "_write", slow)
    with pytest.raises(KS.Conflict):
        KS.upsert(spark, store, _people(spark, [(7, "first run", None)]), ["username"])
    assert KS.read(spark, store).where("pk = 7").first().username == "other run"
    KS.upsert(spark, store, _people(spark, [(7, "first run", None)]), ["username"])
    assert KS.read(spark, store).where("pk = 7").first().username == "first run"
    with pytest.raises(KS.Conflict):
        KS.create(spark, store, FOLLOWINGS, ["pk"])
    assert KS.vacuum(spark, store) >= 1 and KS.read(spark, store).count() == 200


def test_replace_and_empty(spark, store):
    KS.replace(spark, store, _people(spark, [(1, "a", None)]))
    assert KS.read(spark, store).count() == 1
    KS.replace(spark, store, _people(spark, []))
    assert KS.read(spark, store).collect() == [] and KS.read(spark, store).schema == FOLLOWINGS
    KS.upsert(spark, store, _people(spark, []), ["username"])
    with pytest.raises(ValueError, match="no table"):
        KS.read(spark, store + "-none")


def test_store_command(spark, capsys):
    folder, tables = tempfile.mkdtemp(prefix="rollcall-store-"), scratch_path(spark, "t-store-cmd")

    def write(name, *lines):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/x.csv", "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
        return f"{folder}/{name}"

    header = ";" + ";".join(POSTS.fieldNames())  # as exported, with an unnamed index
    first = write("a", header, "0;p1;1;2024-05-01 10:00:00;2;0;3;c;;0;", "1;p2;1;2024-05-01 10:00:00;2;0;3;c;;0;")
    second = write("b", header, "0;p2;1;2024-05-01 10:00:00;2;0;8;c;;0;", "1;p2;1;2024-05-01 10:00:00;2;0;9;c;;0;")
    assert main(["store", "posts", first, tables, "--format", "csv"]) == 0
    assert main(["store", "posts", second, tables, "--format", "csv"]) == 0
    assert {r.post_id: r.like_count for r in KS.read(spark, f"{tables}/posts").collect()} == {"p1": 3, "p2": 9}
    followings = write("c", ";pk;username;full_name", "0;1;a;A", "1;2;b;B")
    assert main(["store", "followings", followings, tables, "--format", "csv"]) == 0
    assert "followings at version 1: 2 rows" in capsys.readouterr().out
