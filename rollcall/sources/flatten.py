"""Flatten landed nested records into typed tables.

Inputs are records landed by the extraction side (JSON / parquet with the
``RAW_*`` schemas of ``rollcall.schemas``); fields are taken by name.
Selecting posts is a semi-join *before* ``explode``, so only the selected
posts' arrays are ever expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.captions import caption_fields, scrub_quotes, with_caption_parts
from rollcall.functions.scalars import to_pk
from rollcall.functions.times import LOCAL_ZONE, to_local, utc_wall, weekday0
from rollcall.schemas import POSTS
from rollcall.session import spread


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """Landed records with a fixed schema (never inferred)."""
    return spark.read.schema(schema).format(fmt).load(path)


def _id(c: Column, as_text: bool) -> Column:
    """A BIGINT id (null where the text is none), or the text itself, for ``scalars.split_ids``."""
    return c.cast("string") if as_text else to_pk(c)


def flatten_users(raw: DataFrame, ids_as_text: bool = False) -> DataFrame:
    """S1 + T1: user records ``u`` → (pk, username, full_name), quotes scrubbed."""
    lead = ["snap_ts"] if "snap_ts" in raw.columns else []
    return raw.select(
        *lead,
        _id(F.col("u.pk"), ids_as_text).alias("pk"),
        F.col("u.username").alias("username"),
        scrub_quotes(F.col("u.full_name")).alias("full_name"),
    )


def _local_and_weekday(df: DataFrame, name: str, basis: str, zone: str):
    utc = utc_wall(df, name)
    local = to_local(utc, zone)
    day = weekday0(utc if basis == "utc" else local)
    return local, day


def flatten_posts(raw: DataFrame, weekday_basis: str = "utc", zone: str = LOCAL_ZONE) -> DataFrame:
    """One row per post; caption parsed (T2), time made local (T3), weekday (T4).

    The weekday comes from the source instant (UTC) by default, as observed;
    ``weekday_basis="local"`` takes it from the local time instead.
    """
    p = with_caption_parts(spread(raw.select("p.*")), "caption")
    local, day = _local_and_weekday(p, "taken_at", weekday_basis, zone)
    text, tags, credit = caption_fields()
    return p.select(
        F.col("id").alias("post_id"),
        F.col("media_type").cast("int").alias("media_type"),
        F.col("comment_count").cast("bigint").alias("comment_count"),
        F.col("like_count").cast("bigint").alias("like_count"),
        text,
        tags,
        F.col("view_count").cast("bigint").alias("view_count"),
        credit,
        local.alias("criado_em_post"),
        day.cast("int").alias("dia_semana_post"),
    ).select(*POSTS.fieldNames())


def _selected(raw: DataFrame, posts: DataFrame | None) -> DataFrame:
    if posts is None:
        return raw
    ids = posts.select(F.col("post_id").cast("string").alias("post_id"))
    return raw.join(ids, "post_id", "left_semi")


def flatten_likes(raw: DataFrame, posts: DataFrame | None = None, ids_as_text: bool = False) -> DataFrame:
    """S3: one row per liker of each selected post; a post without likers gives nothing."""
    sel = _selected(raw, posts)
    return sel.select("post_id", F.explode("likers").alias("l")).select(
        F.col("post_id").alias("post_pk"),
        _id(F.col("l.pk"), ids_as_text).alias("follower_pk"),
        F.col("l.is_private").alias("is_private"),
        F.col("l.stories").alias("stories"),
    )


def flatten_comments(raw: DataFrame, posts: DataFrame | None = None, weekday_basis: str = "utc",
                     zone: str = LOCAL_ZONE, ids_as_text: bool = False) -> DataFrame:
    """One row per comment of each selected post, author struct flattened.

    Names follow the comments table (follower_pk, created_at,
    has_liked_comment); the time is local wall time, the weekday from UTC.
    """
    sel = _selected(raw, posts)
    c = sel.select("post_id", F.explode("comments").alias("c")).select(
        "post_id", "c.*")
    local, day = _local_and_weekday(c, "created_at", weekday_basis, zone)
    return c.select(
        F.col("post_id").alias("post_pk"),
        to_pk(F.col("pk")).alias("comment_pk"),
        F.col("text"),
        _id(F.col("user.pk"), ids_as_text).alias("follower_pk"),
        F.col("user.is_private").alias("is_private"),
        local.alias("created_at"),
        day.cast("int").alias("dia_semana"),
        F.col("content_type"),
        F.col("status"),
        F.col("has_liked").alias("has_liked_comment"),
        F.col("like_count").cast("bigint").alias("like_count"),
    )
