"""The command-line workflows end to end on small fixtures."""

import glob
import os
import tempfile

from rollcall.cli import main
from rollcall.session import scratch_path
from rollcall.streaming import read_history
from tests.test_history import EXPECTED, STEPS, _as_map
from tests.test_streaming import _write_snapshots


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _csv_rows(path):
    """Data lines of all part files (each part carries its own header)."""
    out = []
    for p in sorted(glob.glob(f"{_local(path)}/part-*")):
        out.extend(open(p, encoding="utf-8").read().strip().split("\n")[1:])
    return [ln for ln in out if ln]


def test_history_runs_are_incremental_then_candidates(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-cli-")
    _write_snapshots(folder)
    later = tempfile.mkdtemp(prefix="rollcall-cli-later-")
    for p in sorted(glob.glob(f"{folder}/df_followers_*"))[2:]:  # these arrive after the first run
        os.rename(p, f"{later}/{os.path.basename(p)}")
    store = scratch_path(spark, "t-cli-store")
    assert main(["history", folder, store]) == 0
    out = scratch_path(spark, "t-cli-outbox")
    assert main(["candidates", store, out, "--template", "Oi {}"]) == 0
    assert sorted(_csv_rows(out)) == ["a2;Oi A", "c;Oi C"]
    results = tempfile.mkdtemp(prefix="rollcall-cli-res-")
    with open(f"{results}/r.csv", "w") as fh:
        fh.write("run_id;seq;username;status\nr;1;c;true\nr;2;a2;false\n")
    assert main(["welcomed", store, results]) == 0
    marked = {(r.pk, r.data_saida is None): r.welcome for r in read_history(spark, store).collect()}
    assert marked == {(1, True): None, (2, False): None, (3, True): 1}
    out = scratch_path(spark, "t-cli-outbox2")
    assert main(["candidates", store, out, "--template", "Oi {}"]) == 0
    assert _csv_rows(out) == ["a2;Oi A"]  # c was greeted
    for p in sorted(glob.glob(f"{later}/*")):
        os.rename(p, f"{folder}/{os.path.basename(p)}")
        os.utime(f"{folder}/{os.path.basename(p)}")
    assert main(["history", folder, store]) == 0
    assert _as_map(read_history(spark, store)) == EXPECTED


def test_no_interaction_command(spark):
    import datetime as dt

    from rollcall.schemas import RAW_COMMENTS, RAW_LIKES, RAW_POSTS, RAW_USERS
    from rollcall.sources import write_raw
    utc = dt.timezone.utc
    paths = {k: scratch_path(spark, f"t-cli-{k}") for k in ("posts", "likes", "comments", "users")}
    write_raw(spark.createDataFrame([(("new", dt.datetime(2024, 5, 1, tzinfo=utc), 1, 0, 0, "c", 0),),
                                     (("old", dt.datetime(2023, 1, 1, tzinfo=utc), 1, 0, 0, "c", 0),)],
                                    RAW_POSTS), paths["posts"])
    write_raw(spark.createDataFrame([("new", [("1", False, None)]), ("old", [("2", False, None)])], RAW_LIKES),
              paths["likes"])
    write_raw(spark.createDataFrame([("new", [("9", "hi", ("3", False, None), dt.datetime(2024, 5, 1, tzinfo=utc),
                                               "comment", "Active", False, 0)])], RAW_COMMENTS), paths["comments"])
    write_raw(spark.createDataFrame([(None, (str(k), f"u{k}", f"U{k}")) for k in range(1, 5)], RAW_USERS),
              paths["users"])
    out = scratch_path(spark, "t-cli-noint")
    assert main(["no-interaction", paths["posts"], paths["likes"], paths["comments"], paths["users"], out,
                 "--as-of", "2024-05-02"]) == 0
    assert sorted(ln.split(";")[0] for ln in _csv_rows(out)) == ["2", "4"]


def test_inventory_command(spark, capsys):
    folder = tempfile.mkdtemp(prefix="rollcall-cli-inv-")
    for name in ("a.txt", "b é.txt"):
        open(f"{folder}/{name}", "w").write("x")
    out = scratch_path(spark, "t-cli-inv")
    assert main(["inventory", folder, out]) == 0
    assert "files found: 2" in capsys.readouterr().out


def test_daily_apply_command(spark):
    from rollcall.sources.history_store import read_store
    folder = tempfile.mkdtemp(prefix="rollcall-cli-daily-")
    _write_snapshots(folder)
    store = scratch_path(spark, "t-cli-daily")
    for ts, _rows in STEPS:
        path = f"{folder}/df_followers_{ts:%Y-%m-%d %H%M%S}.csv"
        assert main(["apply", path, store, "--date", ts.date().isoformat()]) == 0
    assert _as_map(read_store(spark, store, len(STEPS) - 1)) == EXPECTED
    # the readers of the other commands see the same store, closed periods included
    assert _as_map(read_history(spark, store)) == EXPECTED
    results = tempfile.mkdtemp(prefix="rollcall-cli-res2-")
    with open(f"{results}/r.csv", "w") as fh:
        fh.write("run_id;seq;username;status\nr;1;b;true\n")
    before = read_history(spark, store).count()
    assert main(["welcomed", store, results]) == 0
    assert read_history(spark, store).count() == before


def test_no_interaction_from_csv_with_rejects_and_protect_list(spark, capsys):
    folder = tempfile.mkdtemp(prefix="rollcall-cli-csv-")

    def write(name, header, *lines):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/x.csv", "w", encoding="utf-8") as fh:
            fh.write("\n".join([header, *lines]) + "\n")

    write("posts", "post_id;criado_em_post;media_type;dia_semana_post;comment_count;like_count;caption_text;hashtags;view_count;repost",
          "p1;2024-05-01 10:00:00;1;2;0;0;c;;0;", "p0;2023-01-01 10:00:00;1;2;0;0;c;;0;")
    write("likes", "follower_pk;post_pk;is_private;stories", "1;p1;false;", "1.0;p1;false;", "2;p0;false;")
    write("comments", "post_pk;comment_pk;text;follower_pk;is_private;created_at;dia_semana;content_type;status;has_liked_comment;like_count",
          "p1;7;hi;3;false;2024-05-01 11:00:00;2;comment;Active;false;0")
    write("followings", "pk;username;full_name", *(f"{k};u{k};U" for k in range(1, 6)), "x9;bad;B")
    write("protect", "username", "u4")
    out = scratch_path(spark, "t-cli-noint-csv")
    args = ["no-interaction", *(f"{folder}/{n}" for n in ("posts", "likes", "comments", "followings")), out,
            "--as-of", "2024-05-02", "--format", "csv", "--protect", f"{folder}/protect", "--stamp", "2024-05-02 101500"]
    assert main(args) == 0
    stamped = f"{out}_2024-05-02 101500"
    assert sorted(ln.split(";")[0] for ln in _csv_rows(stamped)) == ["2", "5"]
    said = capsys.readouterr().out
    assert "likes: 1 rows" in said and "followings: 1 rows" in said and "comments" not in said
    assert _csv_rows(f"{stamped}_rejects/likes") == ["1.0"]


def test_new_followers_command(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-cli-new-")
    for name, rows in (("a.csv", ["0;1;a;A", "1;2;b;B"]), ("b.csv", ["0;2;z;Z", "1;3;c;C", "2;3;d;D"])):
        with open(f"{folder}/{name}", "w") as fh:
            fh.write("\n".join([";pk;username;full_name", *rows]) + "\n")
    first, second = scratch_path(spark, "t-cli-new1"), scratch_path(spark, "t-cli-new2")
    assert main(["new-followers", f"{folder}/a.csv", f"{folder}/none", first, "--at", "2024-01-01 09:00:00"]) == 0
    assert main(["new-followers", f"{folder}/b.csv", first, second, "--at", "2024-01-02 09:00:00"]) == 0
    rows = sorted((r.pk, r.username, r.follow_time.day) for r in spark.read.parquet(second).collect())
    assert rows == [(1, "a", 1), (2, "b", 1), (3, "c", 2)]


def test_no_interaction_from_exports_with_an_unnamed_index(spark):
    """The studied exports lead with an index column that has no name."""
    folder = tempfile.mkdtemp(prefix="rollcall-cli-index-")
    files = {
        "posts": (";post_id;media_type;criado_em_post;dia_semana_post;comment_count;like_count;caption_text;hashtags;view_count;repost", ["0;p1;1;2024-05-01 10:00:00;2;0;0;c;;0;"]),
        "likes": (";post_pk;follower_pk;is_private;stories", ["0;p1;1;False;"]),
        "comments": (";post_pk;comment_pk;text;follower_pk;is_private;created_at;dia_semana;content_type;status;has_liked_comment;like_count",
                     ['0;p1;7;"two\nlines; ""quoted""";3;False;2024-05-01 11:00:00;2;comment;Active;False;0']),
        "followings": (";pk;username;full_name", [f"{k};{k};u{k};U" for k in range(1, 6)]),
    }
    for name, (header, lines) in files.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as fh:
            fh.write("\n".join([header, *lines]) + "\n")
    out = scratch_path(spark, "t-cli-index")
    assert main(["no-interaction", *(f"{folder}/{n}.csv" for n in files), out, "--as-of", "2024-05-02", "--format", "csv"]) == 0
    assert sorted(ln.split(";")[0] for ln in _csv_rows(out)) == ["2", "4", "5"]


def test_late_snapshot_command(spark):
    """``apply`` works an older snapshot in where it belongs."""
    folder, store = tempfile.mkdtemp(prefix="rollcall-cli-late-"), scratch_path(spark, "t-cli-late")
    for day, rows in (("2024-01-01", ["0;1;a;A", "1;2;b;B"]), ("2024-01-05", ["0;1;a;A"]), ("2024-01-03", ["0;1;a;A"])):
        with open(f"{folder}/{day}.csv", "w") as fh:
            fh.write("\n".join([";pk;username;full_name", *rows]) + "\n")
        assert main(["apply", f"{folder}/{day}.csv", store, "--date", day]) == 0
    ends = {r.pk: str(r.data_saida) for r in read_history(spark, store).collect()}
    assert ends == {1: "None", 2: "2024-01-03"}
