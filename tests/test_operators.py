"""K5, K6, W2, J1, J5, D1, D2, K9, O3, T7 golden cases (FIXTURES.md §2)."""

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import (
    accepted_prefix, exclude_protected, extraction_estimate, insert_ignore, mark_welcomed,
    no_interaction, pick_row, posts_since, preview, render_outbox, upsert_replace, welcome_candidates,
)
from rollcall.schemas import FOLLOWERS, RESULTS


def test_upsert_replace_whole_row_last_wins(spark):
    target = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], "k int, a string, b string")
    batch = spark.createDataFrame([(1, "z", 1), (1, "w", 2)], "k int, a string, o int")
    got = sorted(tuple(r) for r in upsert_replace(target, batch, ["k"], ["o"]).collect())
    assert got == [(1, "w", None), (2, "p", "q")]


def test_insert_ignore_first_wins(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new", 1), (2, "p", 1), (2, "q", 2)], "k int, v string, o int")
    got = sorted(tuple(r) for r in insert_ignore(target, batch, ["k"], ["o"]).collect())
    assert got == [(1, "old"), (2, "p")]


def test_pick_row_handles_a_hot_key(spark):
    # one key holds most rows; the aggregate still returns the last one
    df = spark.range(0, 20000).select((F.when(F.col("id") < 15000, 0).otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("o"))
    out = pick_row(df, ["k"], ["o"]).where("k = 0").collect()
    assert [(r.k, r.o) for r in out] == [(0, 14999)]
    plan = pick_row(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # combined map-side before the shuffle


def test_no_interaction_text_ids(spark):
    followings = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", None), (4, "d", None)],
                                       "pk long, username string, full_name string")
    posts = spark.createDataFrame([("p_new", dt.datetime(2024, 5, 1)), ("p_old", dt.datetime(2023, 1, 1))],
                                  "post_id string, criado_em_post timestamp_ntz")
    recent = posts_since(posts, dt.datetime(2024, 5, 2), 115).select("post_id")
    likes = spark.createDataFrame([("p_new", "1"), ("p_old", "2")], "post_pk string, follower_pk string")
    comments = spark.createDataFrame([("p_new", 3)], "post_pk string, follower_pk long")
    likes = likes.join(recent, likes.post_pk == recent.post_id, "left_semi")
    comments = comments.join(recent, comments.post_pk == recent.post_id, "left_semi")
    got = sorted(r.pk for r in no_interaction(followings, likes, comments).collect())
    assert got == [2, 4]


def test_exclude_protected_list_and_frame(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "username string")
    assert sorted(r[0] for r in exclude_protected(df, ["b"]).collect()) == ["a", "c"]
    prot = spark.createDataFrame([("c",), (None,)], "name string")
    assert sorted(r[0] for r in exclude_protected(df, prot).collect()) == ["a", "b"]


def _results(spark, statuses, run="r1"):
    return spark.createDataFrame([(run, i + 1, f"u{i + 1}", s) for i, s in enumerate(statuses)], RESULTS)


def test_accepted_prefix(spark):
    def seqs(st, **kw):
        return sorted(r.seq for r in accepted_prefix(_results(spark, st), **kw).collect())
    assert seqs([True, None, False, True]) == [1, 2]
    assert seqs([True, True, True]) == [1, 2, 3]
    assert seqs([False, True]) == []
    assert seqs([True, False, True], include_failing=True) == [1, 2]
    both = _results(spark, [True, False]).unionByName(_results(spark, [True, True], run="r2"))
    got = sorted((r.run_id, r.seq) for r in accepted_prefix(both).collect())
    assert got == [("r1", 1), ("r2", 1), ("r2", 2)]


def test_welcome_candidates_and_outbox(spark):
    d = dt.date(2024, 1, 1)
    hist = spark.createDataFrame([
        (1, "ana", None, d, None, d, None),              # null full name → username
        (2, "bob", "Bob B", d, None, d, 1),              # already welcomed
        (3, "cid", "Cid", d, dt.date(2024, 1, 2), d, None),  # exited
        (4, "dup", "First", d, None, d, None),
        (5, "dup", "Last", dt.date(2024, 1, 3), None, d, None),  # same username: last wins
    ], FOLLOWERS)
    cand = {r.username: r.convites for r in welcome_candidates(hist).collect()}
    assert cand == {"ana": "ana", "dup": "Last"}
    msg = {r.username: r.message for r in render_outbox(welcome_candidates(hist), "Hi, {}!").collect()}
    assert msg == {"ana": "Hi, ana!", "dup": "Hi, Last!"}


def test_mark_welcomed(spark):
    people = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", 1)],
                                   "pk long, username string, welcome int")
    acc = spark.createDataFrame([("a",), ("a",)], "username string")
    got = sorted(tuple(r) for r in mark_welcomed(people, acc).collect())
    assert got == [(1, "a", 1), (2, "b", None), (3, "c", 1)]


def test_preview_and_estimate(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in preview(df, "k", 3).collect()] == [0, 1, 2]
    assert [r.k for r in preview(df, "k", 2, tail=True).collect()] == [99, 98]
    est = {r.metric: r.value for r in extraction_estimate(df).collect()}
    assert est == {"posts_to_process": 100.0, "estimated_minutes": 100 * 2.5 / 60}


def test_flatten_likes_and_comments(spark):
    import datetime as _d
    from rollcall.schemas import RAW_COMMENTS, RAW_LIKES
    from rollcall.sources import flatten_comments, flatten_likes
    likes = spark.createDataFrame([("p1", [("10", True, "s"), ("11", False, None)]), ("p2", []),
                                   ("p3", [("12", None, None)])], RAW_LIKES)
    posts = spark.createDataFrame([("p1",), ("p2",)], "post_id string")
    got = sorted(tuple(r) for r in flatten_likes(likes, posts).collect())
    assert got == [("p1", 10, True, "s"), ("p1", 11, False, None)]  # p2 has none, p3 not selected
    utc = _d.timezone.utc
    comments = spark.createDataFrame([("p1", [("5", "hi", ("77", True, None), _d.datetime(2024, 1, 1, 0, 30, tzinfo=utc),
                                               "comment", "Active", False, 3)])], RAW_COMMENTS)
    r = flatten_comments(comments).collect()[0]
    assert (r.post_pk, r.comment_pk, r.follower_pk, r.is_private, r.has_liked_comment, r.like_count) == \
        ("p1", 5, 77, True, False, 3)
    assert r.created_at == _d.datetime(2023, 12, 31, 21, 30) and r.dia_semana == 0


def test_columns_named_like_helper_columns(spark):
    """Columns of any name pass through, also those that operators would add themselves."""
    from rollcall.functions.scalars import split_ids
    from rollcall.operators.audience import accepted_prefix, mark_welcomed
    from rollcall.operators.upsert import insert_ignore, pick_row, upsert_replace

    helpers = ["_nth", "_new", "_by0", "_parsed", "_hit", "_cut", "_run"]
    schema = "pk long, username string, seq long, status boolean, run_id string, " + ", ".join(f"{c} string" for c in helpers)
    rows = spark.createDataFrame([(k % 3, f"u{k}", k, k != 2, "r", *helpers) for k in range(4)], schema)
    last = {r.pk: r for r in pick_row(rows, ["pk"], ["seq"]).collect()}
    assert {k: r.seq for k, r in last.items()} == {0: 3, 1: 1, 2: 2} and [last[0][c] for c in helpers] == helpers
    for upsert, seq in ((upsert_replace, 3), (insert_ignore, 0)):
        got = upsert(rows.where("seq < 3"), rows.where("seq = 3"), ["pk"], ["seq"]).where("pk = 0").collect()
        assert [r.seq for r in got] == [seq] and [got[0][c] for c in helpers] == helpers
    assert sorted(r.seq for r in accepted_prefix(rows).collect()) == [0, 1]
    marked = mark_welcomed(rows, rows.where("seq = 1"), "username").collect()
    assert {r.username: r.welcome for r in marked} == {"u0": None, "u1": 1, "u2": None, "u3": None}
    good, bad = split_ids(rows.withColumn("pk", rows["pk"].cast("string")), "pk")
    assert good.count() == 4 and bad.count() == 0 and good.columns == rows.columns
