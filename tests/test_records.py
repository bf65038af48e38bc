"""K3 dumps of records of any fields, the order of written files (O1), and counts that read no columns (A2)."""

import json

from rollcall.operators.audience import table_counts
from rollcall.schemas import PAGE_INVENTORY, RAW_POSTS
from rollcall.session import scratch_path
from rollcall.sources import csv_io as IO
from rollcall.sources import flatten as FL

RECORDS = [
    {"p": {"id": "1", "media_type": 1, "caption": "a\n.\n#x", "like_count": 3, "new": {"deep": [1, {"x": None}], "é": "ü"}}},
    {"p": {"id": "2", "view_count": 2**40, "like_count": "not a number"}, "more": [True, 1.5, "t"]},
    {"p": {"id": "3", "taken_at": "2024-05-01T10:00:00Z"}},
    {},
]


def _landed(spark):
    path = scratch_path(spark, "t-records")
    spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in RECORDS], "value string").coalesce(1).write.text(path)
    return path


def test_records_come_back_unchanged(spark):
    dump = scratch_path(spark, "t-dump")
    IO.write_records(IO.read_records(spark, _landed(spark)), dump)
    back = [json.loads(r[0]) for r in spark.read.parquet(dump).selectExpr("to_json(record)").collect()]
    in_order = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(back, key=in_order) == sorted(RECORDS, key=in_order)


def test_projection_from_the_dump(spark):
    rows = {r.post_id: r for r in FL.flatten_posts(IO.project_records(IO.read_records(spark, _landed(spark)), RAW_POSTS)).collect()}
    assert set(rows) == {"1", "2", "3", None}
    assert rows["1"].caption_text == "a" and rows["1"].hashtags == "#x" and rows["1"].view_count is None
    assert rows["3"].criado_em_post.hour == 7 and rows["3"].like_count is None


def test_places_follow_the_written_files(spark):
    rows = [(f"/p{k % 7:02}", f"f{k:03}", k / 4) for k in range(200)]
    path = scratch_path(spark, "t-order")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        IO.write_inventory_csv(spark.createDataFrame(rows, PAGE_INVENTORY), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = IO.read_export_csv(spark, path, PAGE_INVENTORY, encoding="ISO-8859-1", source_col="file")
    assert back.select("file").distinct().count() > 1
    got = sorted((r.position, r.pasta, r.arquivo) for r in IO.in_file_order(back, "file").collect())
    assert got == [(i, p, f) for i, (p, f, _) in enumerate(sorted(rows))]


def test_counts_read_footers_only(spark):
    """A table's row count takes the row groups' counts: no column is in the scan."""
    path = scratch_path(spark, "t-counts")
    spark.range(1000).selectExpr("id", "cast(id as string) AS s").write.parquet(path)
    counts = table_counts({"t": spark.read.parquet(path)})
    assert [tuple(r)[1] for r in counts.collect()] == [1000]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<>" in plan


def test_rejects_are_counted_by_the_writing_job(spark):
    """What comes back reads the written rows, not the input again; a column named like the helper's stays."""
    from rollcall.sources.checked import checked_ids

    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("2.0", "d"), (" 3 ", "e")], "pk string, _parsed string")
    path = scratch_path(spark, "t-checked")
    good, bad, count = checked_ids(rows, "pk", path)
    assert count == 2 and sorted(tuple(r) for r in bad.collect()) == [("2.0", "d"), ("x", "b")]
    assert sorted((tuple(r) for r in good.collect()), key=str) == [(1, "a"), (3, "e"), (None, "c")]
    for df in (good, bad):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "ExistingRDD" not in plan
