"""K3 raw dump, K10 table definitions and key checks, and skew-shaped inputs."""

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import accepted_prefix, no_interaction
from rollcall.schemas import KEYS, RAW_POSTS, TABLES, create_tables, key_violations
from rollcall.session import scratch_path
from rollcall.sources import flatten_posts, read_landed, write_raw


def test_create_tables_and_key_check(spark):
    root = scratch_path(spark, "t-tables")
    create_tables(spark, root)
    for name, schema in TABLES.items():
        assert spark.table(name).schema == schema
        assert set(KEYS[name]) <= set(schema.fieldNames())
    likes = spark.createDataFrame([("p", 1, True, None), ("p", 1, False, None), ("p", 2, None, None)],
                                  TABLES["likes"])
    dup = key_violations(likes, KEYS["likes"]).collect()
    assert [(r.post_pk, r.follower_pk, r.n) for r in dup] == [("p", 1, 2)]


def test_raw_dump_round_trip(spark):
    utc = dt.timezone.utc
    raw = spark.createDataFrame([((("9", dt.datetime(2024, 1, 1, 0, 0, 7, 123456, tzinfo=utc), 1, 2, 3,
                                    " t\n.\n#a ", 4)),)], RAW_POSTS)
    path = scratch_path(spark, "t-raw")
    write_raw(raw, path)
    back = read_landed(spark, path, RAW_POSTS)
    assert [tuple(r) for r in flatten_posts(back).collect()] == [tuple(r) for r in flatten_posts(raw).collect()]
    assert back.collect()[0].p.taken_at.microsecond == 123456  # Spark's default JSON format keeps ms only


def test_accepted_prefix_with_a_hot_run(spark):
    # run "hot" holds most rows; its first false is at seq 5000
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") < 20000, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 100).cast("string")))
        .alias("run_id"),
        F.col("id").alias("seq"),
        F.lit("u").alias("username"),
        F.when(F.col("id") == 5000, F.lit(False)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.lit(True))
        .alias("status"))
    out = accepted_prefix(df)
    hot = out.where("run_id = 'hot'").agg(F.max("seq"), F.count("*")).first()
    assert tuple(hot) == (4999, 5000)
    assert out.where("run_id <> 'hot'").count() == n - 20000
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_no_interaction_with_a_hot_liker(spark):
    followings = spark.range(1000).select(F.col("id").alias("pk"), F.lit("u").alias("username"))
    likes = spark.range(50000).select(F.lit("p").alias("post_pk"),
                                      F.when(F.col("id") < 40000, F.lit("7"))
                                      .otherwise((F.col("id") % 500).cast("string")).alias("follower_pk"))
    comments = spark.range(0).select(F.lit("p").alias("post_pk"), F.col("id").alias("follower_pk"))
    out = no_interaction(followings, likes, comments)
    assert out.count() == 500 and out.where("pk = 7").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[pk" in plan  # interaction keys are de-duplicated before the anti-join


def test_row_index_with_a_hot_sort_key(spark):
    from rollcall.sources.csv_io import with_row_index
    df = spark.range(40000).select(F.when(F.col("id") < 20000, 0).otherwise(F.col("id")).alias("k"),
                                   "id").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep 8 ranges
    try:
        out = with_row_index(df, ["k"]).checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    r = out.agg(F.min("_index"), F.max("_index"), F.countDistinct("_index")).first()
    assert tuple(r) == (0, 39999, 40000)
    # order holds: every hot-key row precedes every other row
    assert out.where("k = 0").agg(F.max("_index")).first()[0] == 19999
    sizes = [row[1] for row in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 20000  # the hot key is not one partition


def test_bounded_broadcast_hints_only_under_the_bound(spark):
    from rollcall.session import bounded_broadcast
    big = spark.range(5000).withColumnRenamed("id", "k")
    small = spark.range(100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        under = big.join(bounded_broadcast(small, max_rows=1000), "k")
        over = big.join(bounded_broadcast(small, max_rows=10), "k")
        under.collect(), over.collect()
        p_under = under._jdf.queryExecution().executedPlan().toString()
        p_over = over._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p_under          # 100 rows ≤ 1000: hinted
    assert "SortMergeJoin" in p_over and "BroadcastHashJoin" not in p_over  # over the bound: shuffle join
