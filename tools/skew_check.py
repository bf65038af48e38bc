"""Measure how the hot-key-sensitive queries behave when one key holds a third of the events.

Builds skewed copies of the test tables in scratch folders (every third event
reassigned to one user, or moved onto one day; ``events`` written as 16 files
so there are many map tasks), runs the queries on them with Spark's event log
on, and reports per query the largest number of records any single task read
from a shuffle, next to the total shuffled records.  Contrast runs show the
window formulations the operators avoid.

    python tools/skew_check.py [/root/testdata/sf0.1] > SKEW.md
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rollcall.operators import audience as A  # noqa: E402
from rollcall.plans.queries import QUERIES  # noqa: E402
from rollcall.session import build_session, checkpoint_root, scratch_path  # noqa: E402

TABLES_USED = ["customer", "events"]
CHECKED = ["q10_upsert_last_wins", "q12_insert_ignore", "q15_replay_history", "q13_apply_snapshot",
           "q17_no_interaction", "q24_accepted_prefix", "q16_mark_welcomed"]


def _events(log_dir: str) -> list[dict]:
    out = []
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/app*"):
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            out.append(json.loads(line))
    return out


def _shuffle_reads(events: list[dict], jobs: set[int]) -> tuple[int, int]:
    """(largest records read by one task, total records read) over shuffle reads of ``jobs``."""
    stage_job = {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart" and e["Job ID"] in jobs:
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
    top, total = 0, 0
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_job:
            m = e.get("Task Metrics") or {}
            rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            top, total = max(top, rec), total + rec
    return top, total


SCENARIOS = {
    "hot user": ("user 0", lambda df: df.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))),
        "user_id = 0"),
    "hot day": ("2024-01-01", lambda df: df.withColumn(
        "ts", F.when(F.col("event_id") % 3 == 0, F.to_timestamp_ntz(
            F.concat(F.lit("2024-01-01 "), F.date_format("ts", "HH:mm:ss.SSSSSS")))).otherwise(F.col("ts"))),
        "to_date(ts) = date'2024-01-01'"),
}


def main() -> None:
    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="rollcall-eventlog-")
    # partition coalescing off: on tiny data AQE would merge every shuffle into one task,
    # hiding where a hot key lands; 16 reduce partitions as on a cluster slice
    spark = build_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    checkpoint_root(spark)
    tracker = spark.sparkContext.statusTracker()
    results = []

    def measure(rows, label, build):
        before = set(tracker.getJobIdsForGroup(None))
        spark.sparkContext.setJobGroup(label, label)
        build().write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup("", "")
        rows.append((label, set(tracker.getJobIdsForGroup(label)) - before))

    for scenario, (what, skew, hot_pred) in SCENARIOS.items():
        sf = scratch_path(spark, "skewed-tables")
        for name in TABLES_USED:
            df = spark.read.parquet(f"{src}/{name}.parquet")
            if name == "events":
                skew(df).repartition(16).write.parquet(f"{sf}/{name}.parquet")
            else:
                df.write.parquet(f"{sf}/{name}.parquet")
        e = spark.read.parquet(f"{sf}/events.parquet")
        hot, total = e.where(hot_pred).count(), e.count()
        rows = []
        for name in CHECKED:
            measure(rows, f"{scenario}: {name}", lambda n=name: QUERIES[n](spark, sf))
        w = Window.partitionBy("user_id", "event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc())
        measure(rows, f"{scenario}: contrast row_number() = 1 per (user_id, event_type)",
                lambda: e.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn"))
        run = F.col("user_id").cast("string") if scenario == "hot user" else F.date_format("ts", "yyyy-MM-dd")
        runs = e.select(run.alias("run_id"), F.col("event_id").alias("seq"),
                        F.lit(None).cast("string").alias("username"),
                        (F.col("event_type") != "error").alias("status"))
        measure(rows, f"{scenario}: accepted_prefix, run = the hot key (aggregate + join)",
                lambda: A.accepted_prefix(runs, "run_id", ["seq"], "status"))
        first_false = F.min(F.when(~F.col("status"), F.col("seq"))).over(
            Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
        measure(rows, f"{scenario}: contrast running-min window per run = the hot key",
                lambda: runs.withColumn("_cut", first_false).where(F.col("_cut").isNull()).drop("_cut"))
        results.append((scenario, what, hot, total, rows))
    spark.stop()
    events = _events(log_dir)
    print("# SKEW — one key holding a third of the events\n")
    print(f"Generated by `tools/skew_check.py` from `{src}`. Two scenarios: every third event is "
          "reassigned to one user, or moved onto one day (same time of day). `events` is written as "
          "16 files; 16 shuffle partitions; AQE partition coalescing off, so small shuffles are not "
          "merged into one task. For each query: the most shuffle records read by any single task, "
          "against all shuffle records read. A hot key that is not combined before the shuffle shows "
          "up as one task reading about a third of the events (ratio near 1 in the last column).\n")
    for scenario, what, hot, total, rows in results:
        print(f"## {scenario}: {what} holds {hot:,} of {total:,} events\n")
        print("| query | max records read by one task | total shuffle records | max / hot-key rows |")
        print("| --- | --- | --- | --- |")
        for label, jobs in rows:
            top, tot = _shuffle_reads(events, jobs)
            print(f"| {label.split(': ', 1)[1]} | {top:,} | {tot:,} | {top / hot:.3f} |")
        print()


if __name__ == "__main__":
    main()
