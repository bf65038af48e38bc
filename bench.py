"""Headline-query wall times.

Runs the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is built and
executed to completion with the ``noop`` sink (every row produced, nothing
collected); building counts too, since some operators run a small job while
planning (size check of a broadcast side, the run date).  One warm-up pass,
then the median of ``$BENCH_REPEAT`` (default 3) timed passes; ``value`` is
their sum.  The store and stream queries are timed once and listed beside them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.plans.queries import QUERIES  # noqa: E402
from rollcall.session import build_session, checkpoint_root  # noqa: E402

HEADLINE = [
    "q15_replay_history",
    "q13_apply_snapshot",
    "q17_no_interaction",
    "q02_caption_parse",
    "q03_flatten_likes",
    "q04_flatten_comments",
    "q10_upsert_last_wins",
    "q12_insert_ignore",
    "q24_accepted_prefix",
    "q25_local_time",
]
# These write and read stores and files while they are built; timed once each.
STORES = [
    "q05_csv_round_trip",
    "q33_daily_apply_store",
    "q30_snapshot_files_stream",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(app="rollcall-bench")
    checkpoint_root(spark)
    for name in HEADLINE:  # warm-up: JIT, file listing caches
        run_once(spark, name, sf_dir)
    per_query = {}
    for name in HEADLINE:
        per_query[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeat)), 3)
    for name in STORES:
        per_query[name] = round(run_once(spark, name, sf_dir), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(per_query[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
