"""The driver queries q01-q40: each operator of the inventory run over whole test tables.

Every builder takes (spark, sf_dir) and returns a DataFrame; columns are
aliased exactly as in the oracle SQL of ``rollcall.plans.oracle``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.scalars import split_ids
from rollcall.functions.times import to_local, utc_wall, weekday0
from rollcall.operators import audience as A
from rollcall.operators import history as H
from rollcall.operators import upsert as U
from rollcall.operators.preview import preview
from rollcall.plans import standins as X
from rollcall.schemas import COMMENTS, KEYS, LIKES, NEW_FOLLOWERS, PAGE_INVENTORY, POSTS, RAW_POSTS, TABLES, empty, key_violations
from rollcall.session import scratch_path
from rollcall.sources import catalog as C
from rollcall.sources import csv_io as IO
from rollcall.sources import flatten as FL
from rollcall.sources import history_store as HS
from rollcall.sources import inventory as INV
from rollcall.sources import keyed_store as KS
from rollcall.sources import tables as TB
from rollcall.sources.checked import checked_ids
from rollcall.streaming.snapshots import read_history, snapshot_stream


def q01_flatten_users(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_users(X.raw_users(spark, sf))


def q02_caption_parse(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_posts(X.raw_posts(spark, sf))


def q03_flatten_likes(spark: SparkSession, sf: str) -> DataFrame:
    selected = A.posts_since(X.posts(spark, sf), X.POSTS_AS_OF)
    return FL.flatten_likes(X.raw_likes(spark, sf), selected)


def q04_flatten_comments(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_comments(X.raw_comments(spark, sf), X.posts(spark, sf))


def q05_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    orders = X.table(spark, sf, "orders")
    path = scratch_path(spark, "q05-csv")
    IO.write_export_csv(orders, path)
    return IO.read_export_csv(spark, path, orders.schema)


def _catalog_names(spark: SparkSession, sf: str) -> DataFrame:
    e = X.table(spark, sf, "events")
    stamps = e.groupBy(F.to_date("ts").alias("d")).agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd HHmmss").alias("stamp"))
    followers = stamps.select(F.concat(F.lit("CSVs/df_followers_"), "stamp", F.lit(".csv")).alias("path"))
    decoys = stamps.select(F.concat(F.lit("CSVs/df_followings_"), "stamp", F.lit(".csv")).alias("path"))
    pages = X.table(spark, sf, "pages").select(F.regexp_extract("url", r"[^/]*$", 0).alias("path"))
    return followers.unionByName(decoys).unionByName(pages)


def q06_snapshot_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return C.snapshot_catalog(_catalog_names(spark, sf)).select("arquivo", "snap_ts", "snap_date")


def q07_page_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """S7 over a table of paths and sizes: folder, name and MB of every page."""
    return INV.inventory_of(X.table(spark, sf, "pages"), "url", F.octet_length("html"))


def q09_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "q09-table")
    name = "followings_" + path.rsplit("-", 1)[-1]
    U.replace_table(X.people(spark, sf), name, path)
    return U.replace_table(X.followings(spark, sf), name, path)


_EVENT_KEYS = ["user_id", "event_type"]
_EVENT_ORDER = ["ts", "event_id"]


def q10_upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    e = X.table(spark, sf, "events")
    return U.upsert_replace(empty(spark, e.schema), e, _EVENT_KEYS, _EVENT_ORDER)


def q11_upsert_replace_row(spark: SparkSession, sf: str) -> DataFrame:
    e = X.table(spark, sf, "events")
    split = F.lit(X.SPLIT_TS).cast("timestamp_ntz")
    target = U.upsert_replace(empty(spark, e.schema), e.where(F.col("ts") < split), _EVENT_KEYS, _EVENT_ORDER)
    target = target.checkpoint()  # the table as written after the first batch
    batch = e.where(F.col("ts") >= split).drop("props")
    return U.upsert_replace(target, batch, _EVENT_KEYS, _EVENT_ORDER)


def q12_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    e = X.table(spark, sf, "events")
    rows = e.select(F.col("user_id").alias("pk"), F.lit(None).cast("string").alias("username"),
                    F.col("ts").alias("follow_time"), "event_id")
    split = F.lit(X.SPLIT_TS).cast("timestamp_ntz")
    order = ["follow_time", "event_id"]
    first = U.insert_ignore(empty(spark, NEW_FOLLOWERS), rows.where(F.col("follow_time") < split), ["pk"], order)
    first = first.checkpoint()  # the table as written after the first batch
    kept = U.insert_ignore(first, rows.where(F.col("follow_time") >= split), ["pk"], order)
    # names depend on pk only in the stand-in: attach them to the kept rows, not to every event
    return X.attach_names(kept.withColumn("full_name", F.lit(None).cast("string")),
                          X.people(spark, sf)).drop("full_name")


def _history_before_last(spark: SparkSession, sf: str, days: int = 1):
    """(history of all snapshots but the last ``days``, the rows of those, their dates).

    The catalogue (one row per snapshot) is materialised once; the dates are
    read from it, not from another scan of the events.
    """
    rows = X.snapshot_rows(spark, sf)
    catalog = X.snapshot_catalog_rows(rows).checkpoint()
    last = sorted(r[0] for r in catalog.select("snap_date").orderBy(F.desc("snap_date")).limit(days).collect())
    hist = H.replay_history(rows.where(F.col("snap_date") < F.lit(last[0])),
                            catalog.where(F.col("snap_date") < F.lit(last[0])), order="event_id")
    return hist.checkpoint(), rows.where(F.col("snap_date") >= F.lit(last[0])), last  # a history version is a stored table


def q13_apply_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    hist, snap, (last,) = _history_before_last(spark, sf)
    return H.apply_snapshot(hist, snap, last, order="event_id")


def full_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.snapshot_rows(spark, sf)
    return H.replay_history(rows, X.snapshot_catalog_rows(rows), order="event_id")


def q14_welcome_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + F2 + D1 + T6: the history read back as a session table."""
    return A.welcome_candidates(TB.register(full_history(spark, sf), "followers"))


def q15_replay_history(spark: SparkSession, sf: str) -> DataFrame:
    return full_history(spark, sf)


def q16_mark_welcomed(spark: SparkSession, sf: str) -> DataFrame:
    people = X.people(spark, sf).select("pk", "username", F.lit(None).cast("int").alias("welcome"))
    return A.mark_welcomed(people, q24_accepted_prefix(spark, sf), "username")


def q17_no_interaction(spark: SparkSession, sf: str) -> DataFrame:
    likes = X.interactions(spark, sf, "click", as_text=True)
    comments = X.interactions(spark, sf, "view")
    return A.no_interaction(X.followings(spark, sf), likes, comments)


def q18_posts_since(spark: SparkSession, sf: str) -> DataFrame:
    return A.posts_since(X.posts(spark, sf), X.POSTS_AS_OF)


def q19_present_in(spark: SparkSession, sf: str) -> DataFrame:
    hist, snap, _ = _history_before_last(spark, sf)
    return H.present_in(hist, snap)


def q20_exclude_protected(spark: SparkSession, sf: str) -> DataFrame:
    protected = X.table(spark, sf, "customer").where(
        F.col("c_mktsegment") == X.PROTECTED_SEGMENT).select(F.col("c_name").alias("username"))
    return A.exclude_protected(q17_no_interaction(spark, sf), protected)


def q21_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: X.table(spark, sf, n) for n in ("customer", "orders", "lineitem", "events")}
    return (A.table_counts(tables)
            .unionByName(A.unwelcomed_count(full_history(spark, sf)))
            .unionByName(A.extraction_estimate(A.posts_since(X.posts(spark, sf), X.POSTS_AS_OF))))


def q22_preview(spark: SparkSession, sf: str) -> DataFrame:
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    head = preview(o, "o_orderkey", 10).select(F.lit("head").alias("part"), "*")
    tail = preview(o, "o_orderkey", 10, tail=True).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


def q23_last_per_name(spark: SparkSession, sf: str) -> DataFrame:
    return U.pick_row(X.table(spark, sf, "part"), ["p_name"], ["p_partkey"], last=True)


def q24_accepted_prefix(spark: SparkSession, sf: str) -> DataFrame:
    accepted = A.accepted_prefix(X.send_results(spark, sf), "run_id", ["seq"], "status")
    return X.with_usernames(accepted, X.people(spark, sf))


def q25_local_time(spark: SparkSession, sf: str) -> DataFrame:
    e = X.table(spark, sf, "events")
    return e.select("event_id", to_local(F.col("ts")).alias("ts_local"),
                    weekday0(F.col("ts")).cast("int").alias("weekday"))


def q26_outbox(spark: SparkSession, sf: str) -> DataFrame:
    return A.render_outbox(q14_welcome_candidates(spark, sf))


def q27_key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return key_violations(X.table(spark, sf, "part"), ["p_name"])


def q28_page_inventory_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "q28-inventory")
    IO.write_inventory_csv(q07_page_inventory(spark, sf), path)
    back = IO.read_export_csv(spark, path, PAGE_INVENTORY, encoding="ISO-8859-1")
    return back.select("pasta", "arquivo", "tamanho")


def q29_raw_dump(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "q29-raw")
    IO.write_raw(X.raw_posts(spark, sf), path)
    back = FL.read_landed(spark, path, RAW_POSTS)
    return FL.flatten_posts(back)


def _arrive_in_disorder(spark: SparkSession, folder: str) -> None:
    """Spread the files' modification times, so that the stream meets them in another order than their names'."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(root, True)
    while files.hasNext():
        path = files.next().getPath()
        place = int(hashlib.md5(path.getParent().getName().encode()).hexdigest()[:6], 16)
        fs.setTimes(path, (1_700_000_000 + place % 100_000) * 1000, -1)


def q30_snapshot_files_stream(spark: SparkSession, sf: str) -> DataFrame:
    """K1 export of each day's snapshot in its own folder, then the file stream.

    A few files per trigger, in an order that isn't that of the snapshots; every fifth name has a date only.
    """
    rows = X.snapshot_rows(spark, sf)
    whole = F.date_format(F.min("ts"), "yyyy-MM-dd HHmmss")
    stamps = X.table(spark, sf, "events").groupBy(F.to_date("ts").alias("snap_date")).agg(whole.alias("w"))
    stamps = stamps.select("snap_date", F.concat(F.lit("df_followers_"), F.when(F.dayofmonth("snap_date") % 5 == 0, F.substring("w", 1, 10)).otherwise(F.col("w"))).alias("snapshot"))
    snaps = rows.join(stamps, "snap_date").select("snapshot", "pk", "username", "full_name", "event_id")
    folder = scratch_path(spark, "q30-snapshots")
    indexed = IO.with_row_index(snaps, ["event_id"], "snapshot").drop("event_id")
    IO.write_folders(indexed, folder, "snapshot")
    _arrive_in_disorder(spark, folder)
    root = scratch_path(spark, "q30-history")
    q = snapshot_stream(spark, folder, root, scratch_path(spark, "q30-stream"), max_files_per_trigger=4)
    q.awaitTermination()
    return read_history(spark, root)


def q32_page_count(spark: SparkSession, sf: str) -> DataFrame:
    return INV.inventory_count(q07_page_inventory(spark, sf))


def q33_daily_apply_store(spark: SparkSession, sf: str) -> DataFrame:
    """K7 as daily runs against the store, under other partition settings than it was seeded with,
    beside another store of the same folder name."""
    hist, snaps, days = _history_before_last(spark, sf, days=2)
    root, other = (scratch_path(spark, f"q33-{name}") + "/store" for name in ("a", "b"))
    HS.seed_store(spark, root, hist, buckets=8)
    HS.seed_store(spark, other, hist.where(F.col("pk") % 2 == 0), buckets=5)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    try:
        for version, (day, partitions) in enumerate(zip(days, ("4", "16"), strict=True), start=1):
            spark.conf.set(setting, partitions)
            HS.apply_daily(spark, root, snaps.where(F.col("snap_date") == F.lit(day)), day, version, order="event_id")
    finally:
        spark.conf.set(setting, before)
    HS.read_store(spark, other, 0)
    return HS.read_store(spark, root, 2)


def q34_id_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """T5 + J1 with ids that are none: the rejects by table, and the inactive accounts among the others."""
    e = X.table(spark, sf, "events")
    text = F.col("user_id").cast("string")
    bad = F.when(F.col("event_id") % 50 == 0, F.concat(text, F.lit(".0"))).when(F.col("event_id") % 77 == 0, F.concat(F.lit("x"), text)).otherwise(text)
    events = {kind: split_ids(e.where(F.col("event_type") == kind).select(bad.alias("follower_pk")), "follower_pk") for kind in ("click", "view")}
    ppl = X.people(spark, sf)
    marked = ppl.withColumn("pk", F.when(F.col("pk") % 40 == 3, F.concat(F.lit("#"), F.col("pk").cast("string"))).otherwise(F.col("pk").cast("string")))
    good, wrong = split_ids(marked, "pk")
    inactive = A.no_interaction(good, events["click"][0], events["view"][0])
    out = inactive.select(F.lit("inactive").alias("kind"), F.col("pk").cast("string").alias("id"))
    out = out.unionByName(wrong.select(F.lit("following").alias("kind"), F.col("pk").alias("id")))
    for kind, (_, rejects) in events.items():
        out = out.unionByName(rejects.select(F.lit(kind).alias("kind"), F.col("follower_pk").alias("id")))
    return out.groupBy("kind", "id").agg(F.count("*").alias("n"))


def q35_no_interaction_chain(spark: SparkSession, sf: str) -> DataFrame:
    """F1 → S3 / S4 → J1 → J5: nested posts, the recent ones' likes and comments, who gave none, less the protected."""
    posts = FL.flatten_posts(X.raw_order_posts(spark, sf))
    recent = A.posts_since(posts, X.POSTS_AS_OF).select("post_id")
    likes = FL.flatten_likes(X.raw_likes(spark, sf), recent)
    comments = FL.flatten_comments(X.raw_comments(spark, sf), recent)
    protected = X.table(spark, sf, "customer").where(
        F.col("c_mktsegment") == X.PROTECTED_SEGMENT).select(F.col("c_name").alias("username"))
    return A.exclude_protected(A.no_interaction(X.people(spark, sf), likes, comments), protected)


def q36_welcome_loop(spark: SparkSession, sf: str) -> DataFrame:
    """F2 → D1 → D2 → K9 → F2: greet the candidates, mark the accepted in the store, and list who is left."""
    root = scratch_path(spark, "q36-store")
    HS.seed_store(spark, root, full_history(spark, sf))
    history = HS.read_store(spark, root, 0)
    sent = A.candidate_periods(history).select(
        (F.col("pk") % 7).cast("string").alias("run_id"), F.col("pk").alias("seq"), "username", (F.col("pk") % 50 != 0).alias("status"))
    accepted = A.accepted_prefix(sent, "run_id", ["seq"], "status")
    version = HS.mark_store(spark, root, A.accepted_pks(history, accepted))
    return A.candidate_periods(HS.read_store(spark, root, version))


def q37_zoned_local_time(spark: SparkSession, sf: str) -> DataFrame:
    """T3 + T4 over instants around the hours that the page's zone repeats and skips."""
    e = X.table(spark, sf, "events")
    start = F.when(F.col("event_id") % 2 == 0, F.lit(X.REPEATED_HOUR)).otherwise(F.lit(X.SKIPPED_HOUR))
    zoned = e.select("event_id", F.timestamp_micros((start + F.col("event_id") % 600 * 60) * 1_000_000 + F.col("event_id") % 1000).alias("at"))
    utc = utc_wall(zoned, "at")
    return zoned.select("event_id", utc.alias("utc"), to_local(utc).alias("local"), weekday0(utc).cast("int").alias("weekday"))


def q38_upsert_posts(spark: SparkSession, sf: str) -> DataFrame:
    """K5 on the posts table by its key: a second extraction of every third post with other counts."""
    posts = FL.flatten_posts(X.raw_posts(spark, sf))
    again = posts.where(F.col("post_id").cast("bigint") % 3 == 0).withColumn("like_count", F.col("like_count") + 1).drop("view_count")
    target = U.upsert_replace(empty(spark, POSTS), posts, KEYS["posts"], ["criado_em_post"])
    return U.upsert_replace(target, again, KEYS["posts"], ["criado_em_post"])


def q39_upsert_likes(spark: SparkSession, sf: str) -> DataFrame:
    """K5 on the likes table by its two-column key; the selected posts' likes come again, all private."""
    likes = FL.flatten_likes(X.raw_likes(spark, sf))
    again = FL.flatten_likes(X.raw_likes(spark, sf), A.posts_since(X.posts(spark, sf), X.POSTS_AS_OF)).withColumn("is_private", F.lit(True))
    target = U.upsert_replace(empty(spark, LIKES), likes, KEYS["likes"], ["is_private", "stories"])
    return U.upsert_replace(target, again, KEYS["likes"], ["is_private", "stories"])


def q40_upsert_comments(spark: SparkSession, sf: str) -> DataFrame:
    """K5 on the comments table by its key, which repeats over posts here: the latest comment wins."""
    comments = FL.flatten_comments(X.raw_comments(spark, sf))
    return U.upsert_replace(empty(spark, COMMENTS), comments, KEYS["comments"], ["created_at", "post_pk"])


def q41_late_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """K7 out of order: a store seeded with the history of the first days takes the other days' snapshots shuffled."""
    rows = X.snapshot_rows(spark, sf)
    catalog = X.snapshot_catalog_rows(rows).checkpoint()
    days = sorted(r["snap_date"] for r in catalog.collect())  # one row a day
    root, last = scratch_path(spark, "q41-store"), F.lit(days[len(days) // 3])
    HS.seed_store(spark, root, H.replay_history(rows.where(F.col("snap_date") <= last), catalog.where(F.col("snap_date") <= last), order="event_id"), buckets=4)
    days = days[len(days) // 3 + 1:]
    days.sort(key=lambda d: hashlib.md5(str(d).encode()).hexdigest())
    for version, day in enumerate(days, start=1):
        HS.apply_daily(spark, root, rows.where(F.col("snap_date") == F.lit(day)), day, version, order="event_id")
    return HS.read_store(spark, root, len(days))


def q42_split_csv(spark: SparkSession, sf: str) -> DataFrame:
    """S5 in byte ranges: texts with line breaks and quotes, exported and read back in ranges of 64 KB."""
    docs = X.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "q42-csv")
    IO.write_export_csv(docs, path)
    settings = {"spark.sql.files.maxPartitionBytes": str(64 << 10), "spark.sql.files.openCostInBytes": "4096"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return IO.read_export_csv(spark, path, docs.schema, split_bytes=1).checkpoint()  # ranges are settled when the scan is planned
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _stored(spark: SparkSession, name: str, *batches: DataFrame, order: list[str]) -> DataFrame:
    """The table after the batches were upserted into it, one run each."""
    root = scratch_path(spark, f"stored-{name}")
    KS.create(spark, root, TABLES[name], KEYS[name])
    for batch in batches:
        KS.upsert(spark, root, batch, order)
    return KS.read(spark, root)


def q43_stored_posts(spark: SparkSession, sf: str) -> DataFrame:
    """K5 as q38, into the stored table by buckets."""
    posts = FL.flatten_posts(X.raw_posts(spark, sf))
    again = posts.where(F.col("post_id").cast("bigint") % 3 == 0).withColumn("like_count", F.col("like_count") + 1).drop("view_count")
    return _stored(spark, "posts", posts, again, order=["criado_em_post"])


def q44_stored_likes(spark: SparkSession, sf: str) -> DataFrame:
    """K5 as q39, into the stored table by its two-column key."""
    likes = FL.flatten_likes(X.raw_likes(spark, sf))
    again = FL.flatten_likes(X.raw_likes(spark, sf), A.posts_since(X.posts(spark, sf), X.POSTS_AS_OF)).withColumn("is_private", F.lit(True))
    return _stored(spark, "likes", likes, again, order=["is_private", "stories"])


def q45_stored_comments(spark: SparkSession, sf: str) -> DataFrame:
    """K5 as q40, into the stored table."""
    return _stored(spark, "comments", FL.flatten_comments(X.raw_comments(spark, sf)), order=["created_at", "post_pk"])


def q46_load_tables(spark: SparkSession, sf: str) -> DataFrame:
    """K10 + K4 + K5 + K6: all tables created and loaded by their schemas; batches that break a key are refused whole.

    Per table its rows, distinct keys, and batches refused.
    """
    root = scratch_path(spark, "q46-tables")
    KS.create_all(spark, root)
    e = X.table(spark, sf, "events")
    seen = e.select(F.col("user_id").alias("pk"), F.col("ts").alias("follow_time"), "event_id")
    people, followings = X.people(spark, sf), X.followings(spark, sf)
    at = {name: f"{root}/{name}" for name in TABLES}
    KS.append(spark, at["followers"], full_history(spark, sf))
    KS.insert_ignore(spark, at["new_followers"], seen, ["follow_time", "event_id"])
    KS.replace(spark, at["followings"], people)
    KS.replace(spark, at["followings"], followings)
    KS.append(spark, at["posts"], FL.flatten_posts(X.raw_posts(spark, sf)))
    KS.upsert(spark, at["likes"], FL.flatten_likes(X.raw_likes(spark, sf)), ["is_private", "stories"])
    KS.upsert(spark, at["comments"], FL.flatten_comments(X.raw_comments(spark, sf)), ["created_at", "post_pk"])
    KS.append(spark, at["invites"], people.select("username"))
    refused = dict.fromkeys(TABLES, 0)
    bad = {"followings": people.unionByName(people), "new_followers": seen, "invites": people.select(F.when(F.col("pk") % 2 == 0, F.col("username")).alias("username")),
           "posts": FL.flatten_posts(X.raw_posts(spark, sf))}
    for name, batch in bad.items():
        try:
            (KS.replace if name == "followings" else KS.append)(spark, at[name], batch)
        except KS.KeyViolation:
            refused[name] += 1
    out = None
    for name in TABLES:
        counts = KS.read(spark, at[name]).agg(F.count("*").alias("n"), F.countDistinct(F.struct(*KEYS[name])).alias("n_keys"))
        row = counts.select(F.lit(name).alias("table_name"), "n", "n_keys", F.lit(refused[name]).alias("refused"))
        out = row if out is None else out.unionByName(row)
    return out


def q47_raw_variant(spark: SparkSession, sf: str) -> DataFrame:
    """K3 for records whose fields aren't known: dumped untouched, read back, and projected (S2) from the dump.

    Every second record has fields that no schema declares, every fifth lacks one that is declared.
    """
    known = X.raw_posts(spark, sf).select("p.*")
    extra = F.when(F.col("id").cast("bigint") % 2 == 0, F.struct(F.array(F.col("like_count"), F.col("comment_count")).alias("n"), F.col("caption").alias("said")))
    lines = known.select(F.to_json(F.struct(F.struct(*known.columns, extra.alias("extra")).alias("p"), F.lit(None).cast("string").alias("none"))).alias("value"))
    landed, dump = scratch_path(spark, "q47-landed"), scratch_path(spark, "q47-dump")
    lines.write.text(landed)
    IO.write_records(IO.read_records(spark, landed), dump)
    records = spark.read.parquet(dump)
    text = F.to_json("record")
    got = records.select(
        F.variant_get("record", "$.p.id", "string").alias("post_id"), F.try_variant_get("record", "$.p.extra.n[0]", "bigint").alias("extra_n"),
        F.length(F.try_variant_get("record", "$.p.extra.said", "string")).cast("bigint").alias("extra_chars"), F.md5(text).alias("dumped"))
    sent = spark.read.text(landed).select(F.md5(F.to_json(F.parse_json("value"))).alias("dumped"), F.lit(True).alias("unchanged")).distinct()
    flat = FL.flatten_posts(IO.project_records(records, RAW_POSTS)).select("post_id", "view_count", "like_count", "dia_semana_post")
    return got.join(sent, "dumped", "left").drop("dumped").join(flat, "post_id")


def q48_inventory_order(spark: SparkSession, sf: str) -> DataFrame:
    """O1 + K2: every row's place in the written inventory, files by name and rows as they stand."""
    path = scratch_path(spark, "q48-inventory")
    IO.write_inventory_csv(q07_page_inventory(spark, sf), path)
    back = IO.read_export_csv(spark, path, PAGE_INVENTORY, encoding="ISO-8859-1", source_col="file")
    return IO.in_file_order(back, "file").select("position", "pasta", "arquivo")


def q49_checked_ids(spark: SparkSession, sf: str) -> DataFrame:
    """T5 as q34, each input computed once: rows, rejects as counted by the writing job, and distinct rejected ids."""
    e = X.table(spark, sf, "events")
    text = F.col("user_id").cast("string")
    bad = F.when(F.col("event_id") % 50 == 0, F.concat(text, F.lit(".0"))).when(F.col("event_id") % 77 == 0, F.concat(F.lit("x"), text)).otherwise(text)
    out = None
    for kind in ("click", "view"):
        rows = e.where(F.col("event_type") == kind).select(bad.alias("follower_pk"))
        good, rejects, count = checked_ids(rows, "follower_pk", scratch_path(spark, f"q49-{kind}"))
        counts = good.agg(F.count("*").alias("n_good"), F.countDistinct("follower_pk").alias("ids"))
        row = counts.withColumn("one", F.lit(1)).join(rejects.agg(F.countDistinct("follower_pk").alias("rejected_ids")).withColumn("one", F.lit(1)), "one").select(
            F.lit(kind).alias("kind"), "n_good", "ids", F.lit(count).cast("bigint").alias("rejected"), "rejected_ids")
        out = row if out is None else out.unionByName(row)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit()
}
