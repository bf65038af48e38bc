"""Plan properties that matter at scale: pushdown, pruning, shuffle count, join placement."""

import re

from rollcall.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_interaction_pushes_filters_to_the_scan(spark):
    plan = _plan(QUERIES["q17_no_interaction"](spark, SF))
    assert "EqualTo(event_type,click)" in plan and "EqualTo(event_type,view)" in plan
    assert "GreaterThanOrEqual(ts,2024-01-29" in plan
    assert "LeftAnti" in plan


def test_inventory_never_reads_file_content(spark):
    from rollcall.sources.inventory import file_inventory
    plan = _plan(file_inventory(spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "content" not in schema and "length" in schema


def test_replay_shuffles_twice(spark):
    plan = _plan(QUERIES["q15_replay_history"](spark, SF))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # (snap_ts, pk) de-duplication, then pk for both the island window and the period aggregate
    assert len(shuffles) == 2, shuffles
    keys = sorted(tuple(k.split("#")[0] for k in s.split(", ")[:-1]) for s in shuffles)
    assert keys == [("pk",), ("snap_ts", "pk")], keys


def test_likes_semi_join_runs_before_the_nested_grouping(spark):
    plan = _plan(QUERIES["q03_flatten_likes"](spark, SF))
    semi = plan.index("LeftSemi")
    collect = plan.index("partial_collect_list")
    assert semi > collect  # printed below it in the tree, i.e. evaluated first


def test_upsert_reads_and_shuffles_its_batch_once(spark):
    plan = _plan(QUERIES["q10_upsert_last_wins"](spark, SF))
    assert "WindowGroupLimit" in plan and plan.count("Scan parquet") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_chain_selects_posts_below_the_explode(spark):
    plan = _plan(QUERIES["q35_no_interaction_chain"](spark, SF))
    lines = plan.split("\n")
    explode = next(i for i, x in enumerate(lines) if "explode(likers" in x)
    assert any("LeftSemi" in x for x in lines[explode:])  # printed below it, i.e. evaluated first
