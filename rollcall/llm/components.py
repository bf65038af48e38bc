"""Connected components of a link table, by alternating star contraction.

Each round attaches the larger neighbours of every node to its smallest one (large star), then
the smaller ones (small star).  Both are a map-side combined minimum and an equi-join.  The minimum
is checkpointed before it is joined: an aggregate on the key in the join's own stage would keep Spark
from splitting the partition of a node with very many links.  The
link table is checkpointed after every round; only its row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import checkpoint_root


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).checkpoint()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    small = _smallest(links)
    moved = links.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node that has a link; root is the smallest node reachable.

    Self-links, repeated links and links with a null end change nothing; no links give no rows.
    """
    checkpoint_root(links.sparkSession)
    now = (
        links.where(f"{a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
        .checkpoint()
    )
    seen = None
    while True:
        print_ = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_ == seen or not print_[0]:
            break
        seen, now = print_, _small_star(_large_star(now).checkpoint()).checkpoint()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
