"""Golden cases for T1-T4 (FIXTURES.md §2) and a brute-force check of T2."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import parse_caption, run_date, run_date_text, scrub_quotes, stamp
from rollcall.schemas import RAW_POSTS
from rollcall.sources.flatten import flatten_posts

CAPTIONS = [
    ("Olá 'x'\n.\n.\n.\n#a #b, #c.\n#d\n . \n#Repost @u.v\n...\n", "Olá 'x'", "#a #b #c#d", "@uv"),
    ("no tags #in caption", "no tags #in caption", "", ""),
    ("", "", "", ""),
    (None, None, "", ""),
    ("t\n.\n#one\n.\n#two", "t", "#two", ""),
    ("t\n.\n#REPOST @u", "t", "", "#REPOST @u"),
    ("t\n.\n\u00a0\x1f#a\u2003\t", "t", "#a", ""),  # str.strip white space, not only spaces
]


def _parse(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    rows = df.select("i", parse_caption(F.col("c")).alias("p")).orderBy("i").collect()
    return [(r.p.caption_text, r.p.hashtags, r.p.repost) for r in rows]


def test_caption_golden(spark):
    got = _parse(spark, [c[0] for c in CAPTIONS])
    assert got == [c[1:] for c in CAPTIONS]


def _python_reading(caption):
    """Brute force from the rule as stated (T2): first piece; last later piece with
    a tag and no repost mark; last later piece with a repost mark."""
    if caption is None:
        return None, "", ""
    first, *later = re.split("\n ?\\.+ ?\n", caption)
    drop = str.maketrans("", "", ".,\n")
    tagged = [p for p in later if "#" in p and "#repost" not in p.lower()]
    credited = [p for p in later if "#repost" in p.lower()]
    tags = tagged[-1].translate(drop).strip() if tagged else ""
    credit = credited[-1].translate(drop).replace("#Repost ", "").strip() if credited else ""
    return first, tags, credit


ALPHABET = st.sampled_from(list("ab #.,\n@ ") + ["#Repost ", "#repost", "\n.\n", "\n ... \n", "ç"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=8))
def test_caption_matches_brute_force(spark, captions):
    assert _parse(spark, captions) == [_python_reading(c) for c in captions]


def test_scrub_quotes(spark):
    df = spark.createDataFrame([("D'Ávila \"Zé\"",), (None,)], "n string")
    got = [r[0] for r in df.select(scrub_quotes(F.col("n"))).collect()]
    assert got == ["D Ávila  Zé ", None]


def test_post_time_and_weekday(spark):
    utc = dt.timezone.utc
    rows = [((("1", dt.datetime(2024, 1, 1, 0, 30, tzinfo=utc), 1, 2, 3, "c", 4)),),
            ((("2", dt.datetime(2018, 12, 1, 12, 0, tzinfo=utc), 1, 2, 3, None, 4)),)]
    raw = spark.createDataFrame(rows, RAW_POSTS)
    out = {r.post_id: r for r in flatten_posts(raw).collect()}
    assert out["1"].criado_em_post == dt.datetime(2023, 12, 31, 21, 30)
    assert out["1"].dia_semana_post == 0  # Monday in UTC; local would be Sunday (6)
    assert out["2"].criado_em_post == dt.datetime(2018, 12, 1, 10, 0)  # summer time, UTC-2
    local = {r.post_id: r for r in flatten_posts(raw, weekday_basis="local").collect()}
    assert local["1"].dia_semana_post == 6
    assert out["2"].caption_text is None and out["2"].hashtags == "" and out["2"].repost == ""


def test_post_time_independent_of_session_zone(spark):
    utc = dt.timezone.utc
    raw = spark.createDataFrame([((("1", dt.datetime(2024, 1, 1, 0, 30, tzinfo=utc), 1, 2, 3, "c", 4)),)],
                                RAW_POSTS)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = flatten_posts(raw).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.criado_em_post == dt.datetime(2023, 12, 31, 21, 30) and r.dia_semana_post == 0


def test_run_date_and_stamp(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5),)], T.StructType([T.StructField("d", T.DateType())]))
    r = df.select(run_date_text(F.col("d")).alias("t")).select("t", run_date(F.col("t")).alias("d")).first()
    assert r.t == "20240305" and r.d == dt.date(2024, 3, 5)
    assert stamp(dt.datetime(2024, 3, 5, 7, 8, 9)) == "2024-03-05 070809"
    assert stamp(dt.datetime(2024, 3, 5, 7, 8, 9), inventory=True) == "20240305"


def test_flatten_posts_on_a_stream(spark, tmp_path):
    utc = dt.timezone.utc
    raw = spark.createDataFrame([((("1", dt.datetime(2024, 1, 1, 0, 30, tzinfo=utc), 1, 2, 3, "t\n.\n#a", 4)),)],
                                RAW_POSTS)
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(RAW_POSTS).parquet(str(tmp_path / "in"))
    q = (flatten_posts(stream).writeStream.format("memory").queryName("posts_stream_t")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    r = spark.table("posts_stream_t").collect()[0]
    assert (r.post_id, r.caption_text, r.hashtags, r.dia_semana_post) == ("1", "t", "#a", 0)
