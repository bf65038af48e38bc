"""Fixed table definitions (one StructType per table, never inferred).

Table and column names are the data model's own (fixed values): followers,
new_followers, followings, posts, likes, comments and the invite list
(``invites``), plus the extraction inputs, the send-result log and the file
inventory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, NTZ, DT = T.TimestampType(), T.TimestampNTZType(), T.DateType()

# --- persisted tables --------------------------------------------------------
FOLLOWERS = _s(("pk", L), ("username", S), ("full_name", S), ("data_entrada", DT),
               ("data_saida", DT), ("data_update", DT), ("welcome", I))
NEW_FOLLOWERS = _s(("pk", L), ("username", S), ("follow_time", NTZ), ("welcome", I))
FOLLOWINGS = _s(("pk", L), ("username", S), ("full_name", S))
POSTS = _s(("post_id", S), ("media_type", I), ("criado_em_post", NTZ), ("dia_semana_post", I),
           ("comment_count", L), ("like_count", L), ("caption_text", S), ("hashtags", S),
           ("view_count", L), ("repost", S))
LIKES = _s(("post_pk", S), ("follower_pk", L), ("is_private", B), ("stories", S))
COMMENTS = _s(("post_pk", S), ("comment_pk", L), ("text", S), ("follower_pk", L),
              ("is_private", B), ("created_at", NTZ), ("dia_semana", I), ("content_type", S),
              ("status", S), ("has_liked_comment", B), ("like_count", L))
INVITES = _s(("username", S))
RESULTS = _s(("run_id", S), ("seq", L), ("username", S), ("status", B))
FILE_INVENTORY = _s(("pasta", S), ("arquivo", S), ("tamanho", D), ("data_criacao", DT))
PAGE_INVENTORY = _s(("pasta", S), ("arquivo", S), ("tamanho", D))
SCAN_ERRORS = _s(("pasta", S), ("error", S))

# --- extraction inputs (landed records, fields by name) ---------------------
USER = _s(("pk", S), ("username", S), ("full_name", S))
SNAPSHOT = _s(("snap_ts", NTZ), ("pk", L), ("username", S), ("full_name", S))
RAW_USERS = _s(("snap_ts", NTZ), ("u", USER))
RAW_POSTS = _s(("p", _s(("id", S), ("taken_at", TS), ("media_type", I), ("comment_count", L),
                        ("like_count", L), ("caption", S), ("view_count", L))))
LIKER = _s(("pk", S), ("is_private", B), ("stories", S))
RAW_LIKES = _s(("post_id", S), ("likers", T.ArrayType(LIKER)))
COMMENT = _s(("pk", S), ("text", S), ("user", LIKER), ("created_at", TS), ("content_type", S),
             ("status", S), ("has_liked", B), ("like_count", L))
RAW_COMMENTS = _s(("post_id", S), ("comments", T.ArrayType(COMMENT)))

TABLES: dict[str, T.StructType] = {
    "followers": FOLLOWERS,
    "new_followers": NEW_FOLLOWERS,
    "followings": FOLLOWINGS,
    "posts": POSTS,
    "likes": LIKES,
    "comments": COMMENTS,
    "invites": INVITES,
}

# Keys.  followers carries one row per membership period, so its key is
# (pk, data_entrada), not pk alone.
KEYS: dict[str, list[str]] = {
    "followers": ["pk", "data_entrada"],
    "new_followers": ["pk"],
    "followings": ["pk"],
    "posts": ["post_id"],
    "likes": ["post_pk", "follower_pk"],
    "comments": ["comment_pk"],
    "invites": ["username"],
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``; absent columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def create_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> None:
    """Drop and create the persisted tables as parquet tables below ``root``."""
    for name in names or list(TABLES):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name].fields)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = f"{root.rstrip('/')}/{name}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{path}'")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (parquet tables take no constraint)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
