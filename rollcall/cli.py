"""Command-line driver: the page-upkeep workflows as Spark jobs.

    python -m rollcall inventory FOLDER OUT [--hidden]
    python -m rollcall history SNAPSHOTS STORE [--max-files N]
    python -m rollcall apply SNAPSHOT_CSV STORE --date YYYY-MM-DD
    python -m rollcall candidates STORE OUT [--template TEXT]
    python -m rollcall welcomed STORE RESULTS
    python -m rollcall new-followers SNAPSHOT_CSV TABLE OUT --at "YYYY-MM-DD HH:MM:SS"
    python -m rollcall store posts|likes|comments|followings INPUT TABLES [--mode upsert|ignore|replace|append]
                       [--format json|csv]
    python -m rollcall no-interaction POSTS LIKES COMMENTS FOLLOWINGS OUT --as-of YYYY-MM-DD
                       [--days 115] [--format json|csv] [--protect CSV]

Inputs of ``no-interaction`` are landed JSON records (``RAW_POSTS``,
``RAW_LIKES``, ``RAW_COMMENTS``, ``RAW_USERS`` of ``rollcall.schemas``) or
exports of the flattened tables; rows whose ids are none go to OUT_rejects and
are counted.  RESULTS is a ``;`` CSV of (run_id, seq, username, status); the
accepted sends are marked in the store, so the next ``candidates`` leaves them
out.  Dates are arguments read once on the driver, never ``now()`` inside a
plan; ``--stamp "YYYY-MM-DD HHMMSS"`` names an output with its time.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import audience as A
from rollcall.operators.upsert import insert_ignore
from rollcall.schemas import (
    COMMENTS, FOLLOWINGS, INVITES, KEYS, LIKES, NEW_FOLLOWERS, POSTS, RAW_COMMENTS, RAW_LIKES, RAW_POSTS, RAW_USERS, RESULTS, TABLES, empty)
from rollcall.session import build_session, checkpoint_root, scratch_path
from rollcall.sources import csv_io as IO
from rollcall.sources import flatten as FL
from rollcall.sources import history_store as HS
from rollcall.sources import inventory as INV
from rollcall.sources import keyed_store as KS
from rollcall.sources.checked import checked_ids
from rollcall.streaming.snapshots import SNAPSHOT_FILE, read_history, snapshot_stream


def _inventory(spark: SparkSession, a) -> None:
    inv, out = INV.file_inventory(spark, a.folder, hidden=a.hidden), _out(a, a.out)
    IO.write_inventory_csv(inv, out)
    files = INV.inventory_count(spark.read.option("sep", ";").option("header", True)
                                .option("encoding", "ISO-8859-1").csv(out)).first()[0]
    errors = f"; folders with errors: {INV.inventory_errors(spark, a.folder).count()}" if a.hidden else ""
    print(f"files found: {files}{errors}")


def _history(spark: SparkSession, a) -> None:
    """Apply the snapshot files not applied yet: the file stream with an
    available-now trigger, whose checkpoint (inside the store) remembers
    which files it has taken."""
    q = snapshot_stream(spark, a.snapshots, a.store, f"{a.store.rstrip('/')}/_stream",
                        max_files_per_trigger=a.max_files, available_now=True)
    q.awaitTermination()
    done = HS.committed_versions(spark, a.store)
    print(f"history at version {done[-1] if done else 'none'}")


def _out(a, path: str) -> str:
    """The output path, stamped where asked."""
    if not a.stamp:
        return path
    folder, _, name = path.rstrip("/").rpartition("/")
    return IO.stamped(folder or ".", name, a.stamp)


def _apply(spark: SparkSession, a) -> None:
    """One daily run (K7) against the bucketed store: the next version after the last one."""
    done = HS.committed_versions(spark, a.store)
    version = done[-1] + 1 if done else 0
    snap = IO.read_export_csv(spark, a.snapshot, SNAPSHOT_FILE, has_index=True, keep_index=True)
    snap = snap.withColumn(IO.INDEX_COL, F.col(IO.INDEX_COL).cast("bigint"))
    HS.apply_daily(spark, a.store, snap, a.date, version, order=IO.INDEX_COL)
    print(f"history run {version} committed")


def _candidates(spark: SparkSession, a) -> None:
    cands = A.welcome_candidates(read_history(spark, a.store))
    IO.write_export_csv(A.render_outbox(cands, a.template), _out(a, a.out))


def _welcomed(spark: SparkSession, a) -> None:
    results = IO.read_export_csv(spark, a.results, RESULTS, has_index=None)
    accepted = A.accepted_prefix(results, "run_id", ["seq"], "status")
    version = HS.mark_store(spark, a.store, A.accepted_pks(read_history(spark, a.store), accepted))
    print(f"history run {version} committed")


def _new_followers(spark: SparkSession, a) -> None:
    """K6: people of the snapshot that the table doesn't know yet, with the time they were seen."""
    snap = IO.read_export_csv(spark, a.snapshot, SNAPSHOT_FILE, has_index=True, keep_index=True)
    rows = snap.select("pk", "username", F.lit(a.at).cast("timestamp_ntz").alias("follow_time"),
                       F.col(IO.INDEX_COL).cast("bigint").alias("_row")).where(F.col("pk").isNotNull())
    known = HS.exists(spark, a.table)
    target = spark.read.schema(NEW_FOLLOWERS).parquet(a.table) if known else empty(spark, NEW_FOLLOWERS)
    insert_ignore(target, rows, KEYS["new_followers"], ["_row"]).write.parquet(a.out)


def _store(spark: SparkSession, a) -> None:
    """K4, K5, K6: rows into the stored table of their name, made where there is none; later rows of the input win."""
    root = f"{a.tables.rstrip('/')}/{a.name}"
    if KS.latest(spark, root) is None:
        KS.create(spark, root, TABLES[a.name], KEYS[a.name])
    if a.format == "csv":
        rows = IO.read_export_csv(spark, a.input, TABLES[a.name], has_index=None)
    else:
        raw, flatten = {"posts": (RAW_POSTS, FL.flatten_posts), "likes": (RAW_LIKES, FL.flatten_likes),
                        "comments": (RAW_COMMENTS, FL.flatten_comments), "followings": (RAW_USERS, FL.flatten_users)}[a.name]
        rows = flatten(FL.read_landed(spark, a.input, raw))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    mode = a.mode or ("replace" if a.name == "followings" else "upsert")
    if mode in ("upsert", "ignore"):
        done = (KS.upsert if mode == "upsert" else KS.insert_ignore)(spark, root, rows, ["_row"])
    else:
        done = (KS.replace if mode == "replace" else KS.append)(spark, root, rows)
    print(f"{a.name} at version {done.number}: {KS.read(spark, root, done).count()} rows")


def _checked(spark: SparkSession, df, name: str, out: str, label: str):
    """``df`` without rows whose id is none; those go to ``out``_rejects."""
    good, bad, count = checked_ids(df, name, scratch_path(spark, f"checked-{label}"))
    if count:
        IO.write_export_csv(bad, f"{out}_rejects/{label}")
        print(f"{label}: {count} rows without a valid id in {out}_rejects/{label}")
    return good


def _no_interaction(spark: SparkSession, a) -> None:
    out = _out(a, a.out)
    if a.format == "csv":
        posts, likes, comments, followings = (
            IO.read_export_csv(spark, path, _texts(schema, ids), has_index=None)
            for path, schema, ids in ((a.posts, POSTS, ()), (a.likes, LIKES, ("follower_pk",)),
                                      (a.comments, COMMENTS, ("follower_pk",)), (a.followings, FOLLOWINGS, ("pk",))))
        recent = A.posts_since(posts, a.as_of, a.days).select(F.col("post_id").alias("post_pk"))
        likes, comments = (x.join(recent, "post_pk", "left_semi") for x in (likes, comments))
    else:
        posts = FL.flatten_posts(FL.read_landed(spark, a.posts, RAW_POSTS))
        recent = A.posts_since(posts, a.as_of, a.days).select("post_id")
        likes = FL.flatten_likes(FL.read_landed(spark, a.likes, RAW_LIKES), recent, ids_as_text=True)
        comments = FL.flatten_comments(FL.read_landed(spark, a.comments, RAW_COMMENTS), recent, ids_as_text=True)
        followings = FL.flatten_users(FL.read_landed(spark, a.followings, RAW_USERS), ids_as_text=True).drop("snap_ts")
    likes = _checked(spark, likes.select("follower_pk"), "follower_pk", out, "likes")
    comments = _checked(spark, comments.select("follower_pk"), "follower_pk", out, "comments")
    followings = _checked(spark, followings, "pk", out, "followings")
    inactive = A.no_interaction(followings, likes, comments)
    if a.protect:
        inactive = A.exclude_protected(inactive, IO.read_export_csv(spark, a.protect, INVITES, has_index=None))
    IO.write_export_csv(inactive, out)


def _texts(schema: T.StructType, ids: tuple[str, ...]) -> T.StructType:
    """``schema`` with its ids as text, so that bad ones can be reported."""
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in ids else f for f in schema.fields])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rollcall")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("inventory", help="files below a folder → Latin-1 ; CSV")
    s.add_argument("folder"), s.add_argument("out"), s.add_argument("--hidden", action="store_true")
    s.set_defaults(run=_inventory)
    s = sub.add_parser("history", help="apply new df_followers_* snapshot files (incremental)")
    s.add_argument("snapshots"), s.add_argument("store"), s.add_argument("--max-files", type=int, default=100)
    s.set_defaults(run=_history)
    s = sub.add_parser("apply", help="one daily snapshot run against the pk-bucketed store")
    s.add_argument("snapshot"), s.add_argument("store")
    s.add_argument("--date", required=True, type=_dt.date.fromisoformat)
    s.set_defaults(run=_apply)
    s = sub.add_parser("candidates", help="welcome outbox from the current history")
    s.add_argument("store"), s.add_argument("out"), s.add_argument("--template", default=A.WELCOME_TEMPLATE)
    s.set_defaults(run=_candidates)
    s = sub.add_parser("welcomed", help="mark accepted sends (prefix before the first failure)")
    s.add_argument("store"), s.add_argument("results")
    s.set_defaults(run=_welcomed)
    s = sub.add_parser("new-followers", help="insert the people of a snapshot that the table lacks")
    s.add_argument("snapshot"), s.add_argument("table"), s.add_argument("out")
    s.add_argument("--at", required=True)
    s.set_defaults(run=_new_followers)
    s = sub.add_parser("no-interaction", help="followed accounts without likes or comments")
    for name in ("posts", "likes", "comments", "followings", "out"):
        s.add_argument(name)
    s.add_argument("--as-of", required=True, type=_dt.date.fromisoformat)
    s.add_argument("--days", type=int, default=A.CUTOFF_DAYS)
    s.add_argument("--format", choices=("json", "csv"), default="json")
    s.add_argument("--protect", help="; CSV of usernames never listed")
    s.set_defaults(run=_no_interaction)
    s = sub.add_parser("store", help="rows into a stored table, by its key")
    s.add_argument("name", choices=("posts", "likes", "comments", "followings"))
    s.add_argument("input"), s.add_argument("tables")
    s.add_argument("--mode", choices=("upsert", "ignore", "replace", "append"), help="followings are replaced, others upserted by default")
    s.add_argument("--format", choices=("json", "csv"), default="json")
    s.set_defaults(run=_store)
    for s in sub.choices.values():
        s.add_argument("--stamp", type=lambda v: _dt.datetime.strptime(v, "%Y-%m-%d %H%M%S"), help="name the output with this time")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(app=f"rollcall-{args.cmd}")
    checkpoint_root(spark)
    args.run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
