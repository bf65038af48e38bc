"""Stand-ins: the audience data model expressed over the driver's test tables.

person = ``customer`` (pk = c_custkey, username = c_name, full_name =
c_mktsegment, null for every seventh key so the name fallback is exercised);
follower snapshot of day d = the ``user_id``s of ``events`` on d, with names
that change by day and event;
like = a ``click`` event, comment = a ``view`` event; post = an ``orders``
row; likers per post = ``lineitem``; comments per post = ``conversations``;
captions and names = ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the driver queries.
INTERACTION_CUTOFF = "2024-01-29 00:00:00"   # likes / comments counted from here on
POSTS_AS_OF = "2001-08-01 00:00:00"          # last order date of the test tables
SPLIT_TS = "2024-01-15 00:00:00"             # first batch before, second batch from here on
POST_EPOCH, POST_STEP = 1_500_000_000, 86_399  # seconds of the first post, and between posts
REPEATED_HOUR, SKIPPED_HOUR = 1_518_900_000, 1_541_289_600  # instants hours before the zone's changes of 2018
PROTECTED_SEGMENT = "BUILDING"               # protect list = customers of this segment


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read once per path and then stated, so later
    reads skip the footer-reading job (as a catalog table would)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _SCHEMAS.get(path)
    if known is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[path] = df.schema
    return df


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("pk"),
        F.col("c_name").alias("username"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("full_name"),
    )


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snap_ts, snap_date, pk, username, full_name, event_id): one snapshot per day.

    A user with several events on a day is listed that often; the first by
    event_id counts.  Names change: the username by day (two users share one),
    the full name by event, and it is null on ``signup``.
    """
    e = table(spark, sf_dir, "events")
    d, pk = F.to_date("ts"), F.col("user_id")
    return e.select(
        d.cast("timestamp_ntz").alias("snap_ts"), d.alias("snap_date"), pk.alias("pk"),
        F.concat(F.lit("user"), (pk - pk % 2).cast("string"), F.lit("."), (F.dayofmonth("ts") % 3).cast("string")).alias("username"),
        F.when(F.col("event_type") != "signup", F.concat("event_type", F.lit(" "), (pk % 5).cast("string"))).alias("full_name"),
        "event_id")


def snapshot_catalog_rows(rows: DataFrame) -> DataFrame:
    """The test tables hold a snapshot every day, so the catalogue may come from rows."""
    return rows.select("snap_ts", "snap_date").distinct()


def attach_names(df: DataFrame, ppl: DataFrame) -> DataFrame:
    """``df`` with the person table's names instead of its own."""
    cols = df.columns
    return df.drop("username", "full_name").join(ppl, "pk", "left").select(*cols)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("post_id"),
                    F.col("o_orderdate").alias("criado_em_post"))


def followings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People with at least one event."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("pk"))
    return people(spark, sf_dir).join(users, "pk", "left_semi")


def interactions(spark: SparkSession, sf_dir: str, kind: str, as_text: bool = False) -> DataFrame:
    """Likes (``click``) or comments (``view``) since the cutoff: (post_pk, follower_pk)."""
    e = table(spark, sf_dir, "events").where(
        (F.col("event_type") == kind) & (F.col("ts") >= F.lit(INTERACTION_CUTOFF).cast("timestamp_ntz")))
    pk = F.col("user_id").cast("string") if as_text else F.col("user_id")
    return e.select(F.col("event_id").cast("string").alias("post_pk"), pk.alias("follower_pk"))


def send_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """results(run_id, seq, user_id, status): a day's sends in event order.

    status = sent (false on ``error``), unknown (null) on ``signup``.  The
    recipient's username is attached by ``with_usernames`` after the rows are
    cut down, so the name join never runs over the whole log.
    """
    e = table(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("user_id"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("boolean"))
        .otherwise(F.col("event_type") != "error").alias("status"),
    )


def with_usernames(df: DataFrame, ppl: DataFrame, key: str = "user_id") -> DataFrame:
    """Replace ``key`` by the person's username (left join: unknown ids keep a null name)."""
    names = ppl.select(F.col("pk").alias(key), "username")
    cols = [c if c != key else "username" for c in df.columns]
    return df.join(names, key, "left").select(*cols)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.struct(F.col("doc_id").cast("string").alias("pk"),
                             F.col("source").alias("username"),
                             F.col("text").alias("full_name")).alias("u"))


def caption_of(doc: DataFrame) -> F.Column:
    """Captions over whole texts: no tags / tags / credit / both, by doc_id mod 4."""
    tags = F.concat(F.lit("\n.\n#"), F.col("source"), F.lit(". #"), F.col("lang"), F.lit(",\n#x"))
    credit = F.concat(F.lit("\n ... \n#Repost @"), F.col("source"), F.lit(".a"))
    k = F.col("doc_id") % 4
    return (F.when(k == 0, F.col("text"))
            .when(k == 1, F.concat(F.col("text"), tags))
            .when(k == 2, F.concat(F.col("text"), credit))
            .otherwise(F.concat(F.col("text"), tags, credit)))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts from documents: times over several years, counts, and every fifth without a view count."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.timestamp_seconds(F.lit(POST_EPOCH) + F.col("doc_id") * POST_STEP).alias("taken_at"),
        F.lit(1).alias("media_type"),
        (F.col("doc_id") % 13).alias("comment_count"),
        F.col("n_chars").alias("like_count"),
        caption_of(d).alias("caption"),
        F.when(F.col("doc_id") % 5 != 0, F.col("n_chars") * 3).alias("view_count"),
    ).alias("p"))


def raw_order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts from orders, whose likers and comments the other tables hold."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("taken_at"),
        F.lit(1).alias("media_type"), F.lit(None).cast("bigint").alias("comment_count"),
        F.lit(None).cast("bigint").alias("like_count"), F.col("o_orderpriority").cast("string").alias("caption"),
        F.lit(None).cast("bigint").alias("view_count"),
    ).alias("p"))


def _pages_of(df: DataFrame, key: str, item: F.Column, name: str) -> DataFrame:
    """Nested records: items gathered per key *and input partition*, like paged
    API results, so a hot key is spread over many bounded records."""
    return (df.withColumn("_page", F.spark_partition_id())
            .groupBy(F.col(key).cast("string").alias("post_id"), "_page")
            .agg(F.collect_list(item).alias(name))
            .drop("_page"))


def raw_likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    liker = F.struct(F.col("l_suppkey").cast("string").alias("pk"),
                     (F.col("l_returnflag") == "R").alias("is_private"),
                     F.col("l_linestatus").alias("stories"))
    return _pages_of(li, "l_orderkey", liker, "likers")


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    user = F.struct(F.col("conv_id").cast("string").alias("pk"),
                    (F.col("role") == "assistant").alias("is_private"),
                    F.col("role").alias("stories"))
    created = F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 86400 + F.col("turn") * 3600)
    comment = F.struct(F.col("turn").cast("string").alias("pk"), F.col("text"), user.alias("user"),
                       created.alias("created_at"), F.col("role").alias("content_type"),
                       F.lit("Active").alias("status"), (F.col("turn") % 2 == 0).alias("has_liked"),
                       F.length("text").cast("bigint").alias("like_count"))
    return _pages_of(cv, "conv_id", comment, "comments")
