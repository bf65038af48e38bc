"""Mixing sources to target weights (op7): min-cost flow over membership patterns.

Documents may belong to several sources.  They are aggregated by membership pattern (the sorted
set of their sources), and only the patterns' sizes go into the flow: capacity enters each
pattern once at no cost, a second time at cost 1, and so on (convex), and leaves it to any of the
pattern's sources up to their quotas.  Within a pattern, documents are then selected in the order
of a seeded hash; where the cut lies is found by two histograms of that hash and the few documents
of one cell, so no task orders a whole source.

The driver holds one row per pattern, at most ``MAX_PATTERNS``; more is an error.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.store import table, written
from rollcall.llm.text import words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = 20240229
MAX_PATTERNS = 100_000


def fill(sizes: list[int], weights: list[int], total: float, repeats: int) -> list[float]:
    """Targets by weight, none above ``repeats`` times its size; the excess is shared again by weight."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        rest, weight = total - sum(targets[i] for i in range(len(sizes)) if i not in open_), sum(weights[i] for i in open_)
        above = [i for i in open_ if rest * weights[i] / weight > repeats * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = rest * weights[i] / weight
            break
        for i in above:
            targets[i] = float(repeats * sizes[i])
            open_.remove(i)
    return targets


def flow(patterns: list[tuple[int, ...]], sizes: list[int], quotas: list[int], repeats: int) -> list[int]:
    """Tokens through each pattern, by successive cheapest paths.

    Of several cheapest plans the one whose paths come first by number is taken, so reruns agree.
    """
    taken = [0] * len(patterns)
    into: list[dict[int, int]] = [{} for _ in patterns]  # pattern -> source: tokens
    members: dict[int, list[int]] = {}
    for p, sources in enumerate(patterns):
        for s in sources:
            members.setdefault(s, []).append(p)
    left = list(quotas)

    def cheapest(source: int) -> list[int] | None:
        """Patterns and sources in turn, from ``source`` back to a pattern with room, at the lowest pass number."""
        came: dict[tuple[str, int], tuple[str, int] | None] = {("s", source): None}
        queue, best, at = deque([("s", source)]), None, None
        while queue:
            node = queue.popleft()
            if node[0] == "s":
                for p in members.get(node[1], ()):
                    if ("p", p) not in came:
                        came["p", p] = node
                        queue.append(("p", p))
                        if taken[p] < repeats * sizes[p] and (best is None or taken[p] // sizes[p] < best):
                            best, at = taken[p] // sizes[p], ("p", p)
            else:
                for s, tokens in into[node[1]].items():
                    if tokens and ("s", s) not in came:
                        came["s", s] = node
                        queue.append(("s", s))
        path = []
        while at:
            path.append(at[1])
            at = came[at]
        return path or None

    # a pass at a time over all sources: a repetition is bought by none while another has first copies
    waiting = deque(s for s in range(len(quotas)) if left[s])
    for pass_ in range(repeats):
        retry = deque()
        while waiting:
            s = waiting.popleft()
            path = cheapest(s)
            if path is None:
                continue
            p = path[0]
            if taken[p] // sizes[p] > pass_:
                retry.append(s)
                continue
            amount = min([left[s], (pass_ + 1) * sizes[p] - taken[p]] + [into[q][t] for q, t in zip(path[2::2], path[1::2], strict=False)])
            taken[p] += amount
            for k in range(0, len(path), 2):  # tokens of path[k] go to path[k + 1], which gives up those of path[k + 2]
                into[path[k]][path[k + 1]] = into[path[k]].get(path[k + 1], 0) + amount
                if k + 2 < len(path):
                    into[path[k + 2]][path[k + 1]] -= amount
            left[s] -= amount
            if left[s]:
                waiting.append(s)
        waiting = retry
    return taken


def plan(rows: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> tuple[list, dict, dict]:
    """Patterns with ``(passes, rest)``, and each source's size and target, from ``pattern, size`` per row."""
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    sums = sorted(((tuple(r["pattern"]), r["size"]) for r in sums), key=lambda r: [(x is None, x or "") for x in r[0]])
    sources = sorted({s for p, _ in sums for s in p}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(sources)}
    of_source = [0] * len(sources)
    for p, size in sums:
        for s in p:
            of_source[number[s]] += size
    targets = fill(of_source, [weights[i % len(weights)] for i in range(len(sources))], share * sum(size for _, size in sums), repeats)
    full = [(p, size) for p, size in sums if size]
    taken = flow([tuple(number[s] for s in p) for p, _ in full], [size for _, size in full], [int(t) for t in targets], repeats)
    parts = [(p, *divmod(t, size)) for (p, size), t in zip(full, taken, strict=True)]
    return parts, dict(zip(sources, of_source, strict=True)), dict(zip(sources, targets, strict=True))


def _bin(level: int):
    return F.expr(f"shiftrightunsigned(r, {53 - 10 * level}) & 1023")


def _cuts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``pattern, passes, upto``: documents with hash up to ``upto`` are taken once more than ``passes``."""
    keyed, cells = rows, parts.withColumn("before", F.lit(0).cast("long"))
    by = ["pattern"]
    for level in (0, 1):
        name = f"bin{level}"
        keyed = keyed.withColumn(name, _bin(level))
        sums = keyed.join(F.broadcast(cells.select(*by, "rest", "before")), by).groupBy(*by, "rest", "before", name).agg(F.sum("size").alias("size"))
        upto = Window.partitionBy(*by).orderBy(name)
        sums = sums.withColumn("after", F.col("before") + F.sum("size").over(upto)).where("after > rest")
        cut = sums.groupBy(*by).agg(F.min_by(F.struct(name, (F.col("after") - F.col("size")).alias("before")), name).alias("c"))
        cells = cells.drop("before").join(cut, by).select(*by, "passes", "rest", F.col(f"c.{name}").alias(name), "c.before")
        cells, by = written(cells, "cells"), [*by, name]
    cell = keyed.join(F.broadcast(cells), by).groupBy("pattern", "rest", "before", "r").agg(F.sum("size").alias("size"))
    cell = cell.withColumn("after", F.col("before") + F.sum("size").over(Window.partitionBy("pattern").orderBy("r")))
    last = cell.where("after - size / 2 <= rest").groupBy("pattern").agg(F.max("r").alias("r"))
    shifted = [F.col(f"bin{level}").cast("long") * (1 << (53 - 10 * level)) for level in (0, 1)]
    cells = cells.join(last, "pattern", "left")
    return cells.select("pattern", "passes", F.when(F.col("rest") > 0, F.coalesce("r", shifted[0] + shifted[1] - 1)).otherwise(-1).alias("upto"))


def sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``docs`` with ``_m``: size in words, membership pattern and seeded hash."""
    kind = docs.schema[source].dataType
    many = isinstance(kind, T.ArrayType)
    size = F.size(words(text)).cast("long")
    members = F.sort_array(F.array_distinct(F.coalesce(source, F.array().cast(kind))), asc=True) if many else F.array(F.col(source).cast("string"))
    members = F.when(F.size(members) > 0, members).otherwise(F.array(F.lit(None).cast("string"))) if many else members
    r = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(doc_id), members), 1)
    return docs.withColumn("_m", F.struct(size.alias("size"), members.alias("pattern"), r.alias("r")))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, carry: tuple[str, ...] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, sources)``: ``docs`` with ``_size``, ``_pattern`` and ``_passes`` (how often the mix takes the row), and each source's size and target.

    Sources by code point, null last, weigh ``weights`` in turn; together they get ``share`` times
    all words, none more than ``repeats`` times its own.  ``source`` is one name or an array of
    names; a row without any belongs to the null source.  A null text has no words and is never
    taken.  Rows with equal id and pattern are taken alike.  No rows give no rows.  ``carry`` names
    the columns of ``docs`` that are wanted, where they are few enough to be written with the sizes.
    """
    spark = docs.sparkSession
    rows = sized(docs, doc_id, text, source)
    if carry is not None:
        rows = written(rows.select(*carry, "_m"), "sizes")
        marks = rows.select("_m.*")
    else:
        marks = written(rows.select("_m.*"), "sizes")
    parts, of_source, targets = plan(marks, weights, share, repeats)
    cuts = _cuts(marks.where("size > 0"), spark.createDataFrame(parts, "pattern array<string>, passes long, rest long"))
    cuts = written(cuts, "cuts").withColumnsRenamed({"pattern": "_p", "passes": "_n", "upto": "_upto"})
    joined = rows.join(F.broadcast(cuts), F.col("_m.pattern") == F.col("_p"), "left")  # one row per pattern
    passes = F.coalesce(F.col("_n") + F.when(F.col("_m.r") <= F.col("_upto"), 1).otherwise(0), F.lit(0))
    passes = F.when(F.col("_m.size") > 0, passes).otherwise(0).cast("long")
    out = joined.withColumns({"_size": F.col("_m.size"), "_pattern": F.col("_m.pattern"), "_passes": passes}).drop("_m", "_p", "_n", "_upto")
    named = [(s, of_source[s], float(targets[s])) for s in of_source]
    return out, spark.createDataFrame(named, "name string, source_size long, target double")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sources = mix(table(spark, sf_dir, "documents"), carry=("doc_id",))
    rows = rows.join(F.broadcast(sources), F.col("_pattern")[0].eqNullSafe(F.col("name")))  # one row per source
    return rows.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_passes")).alias("taken"))
