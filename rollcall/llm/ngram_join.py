"""N-gram Jaccard join (op10): a blocked sparse product of the document by n-gram incidence.

The product of the incidence matrix with its transpose holds the overlap of every two documents.
Only the column block that can decide is multiplied: n-grams are put in one global order, rare
ones first, and a document of n n-grams enters with its first ``n - ceil(0.9 n) + 1``.  Overlap
counts of that block are accumulated per pair, and a pair goes when even all n-grams beyond the
block could not lift it to the overlap that its two sizes ask for.  The rest is multiplied out in
full, from the whole texts.

* Order: a count sketch of fixed size (``SKETCH`` counters, summed over all documents).  Any
  global order gives the same links; the counts only keep frequent n-grams out of the block.
* Equal sets are one class before anything else, so copies are never paired.
* A group of near copies shares its block columns.  Columns with more than ``LEADERS`` documents
  first link to the ``LEADERS`` members that share most; the product then leaves out pairs that
  are already in one component and pairs only documents outside a column's largest component with
  the others.  No pair between different components is left out.

N-grams, sets and classes are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.store import forget, modest_batches, table, written
from rollcall.llm.textvec import U, Windows, Words, chunks, frugal, lower_ascii, mix
from rollcall.session import bounded_broadcast

SKETCH_BITS = 20
SKETCH_PARTS = 64
LEADERS = 16
ROWS = 1024  # members of a column that meet in one block of the product
CELLS = 4096  # n-grams of one side of a block that are multiplied at a time


def _ceil(a, b: int):
    return -(-a // b)


def _smallest(percent: int) -> float:
    """The least s with ``100 * s >= percent * (s + 1)``: smaller sets link with equal sets only."""
    return _ceil(percent, 100 - percent) if percent < 100 else float("inf")


def ngram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    for row, end, data, offsets in chunks(column):
        words = Words(lower_ascii(data), offsets)
        hashed = Windows(words.hashes())
        grams, first = hashed.hashes(n), words.first
        for i in range(end - row):
            s, e = first[i], first[i + 1]
            if e - s >= n:
                yield np.unique(grams[s : e - n + 1])
            elif e > s:
                yield hashed.spans(np.array([s]), np.array([e]))
            else:
                yield np.zeros(0, U)


def _sketch(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Occurrences of n-grams by the first bits of their hash, over all documents."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words = Words(lower_ascii(data), offsets)
                hashed = Windows(words.hashes())
                grams = hashed.hashes(n)[hashed.valid(words.first, n)]
                total += np.bincount((grams >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        parts = [total[i * width : (i + 1) * width].tobytes() for i in range(SKETCH_PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[part] = totals.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    parts = docs.select(text).mapInArrow(frugal(count), schema).repartition(SKETCH_PARTS, "part").mapInArrow(add, schema)
    whole = np.zeros(1 << SKETCH_BITS, np.int64)
    for part, counts in parts.collect():  # SKETCH_PARTS rows of fixed size
        whole[part * width : (part + 1) * width] = np.frombuffer(counts, np.int64)
    return whole


def _incidence(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """Per row: doc_id, a hash of the text, the set's size and hash, and the n-grams of its column block."""
    counts = docs.sparkSession.sparkContext.broadcast(_sketch(docs, text, n))
    smallest = _smallest(percent)

    def block(batches):
        order = counts.value
        for batch in batches:
            nodes, sizes, prefixes = [], [], []
            for grams in ngram_sets(batch.column(2), n):
                size = len(grams)
                sizes.append(size)
                nodes.append(mix(np.array([grams.sum(dtype=U) + U(size)]))[0].view(np.int64))
                keep = size - _ceil(percent * size, 100) + 1 if size >= smallest else 0
                rare = np.argsort(order[(grams >> U(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")[:keep]
                prefixes.append(grams[rare].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate([*prefixes, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "tk", "node", "n", "block"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), F.col(text).alias("text"))
    return rows.mapInArrow(frugal(block), "doc_id long, tk long, node long, n long, block array<long>")


def _overlapping(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose whole sets overlap enough."""

    def product(batches):
        for batch in batches:
            keep = []
            for x, y in zip(ngram_sets(batch.column(2), n), ngram_sets(batch.column(3), n), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(pairs.select("a", "b"), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = bounded_broadcast(nodes.join(classes.select("node", "tk"), "node"))
    texts = docs.select(F.xxhash64(text).alias("tk"), F.col(text).alias("text")).join(wanted, "tk")
    texts = written(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    sides = sides.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    links = written(sides.select("a", "b", "text_a", "text_b").mapInArrow(frugal(product), "a long, b long"), "links")
    forget(pairs, texts)
    return links


def _size_fits(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _asked(na, nb, percent: int):
    """Overlap inside the blocks without which two sets of these sizes can't link: beyond its block a set of n has ``ceil(percent * n / 100) - 1`` n-grams."""
    return _ceil(percent * (na + nb), 100 + percent) - (_ceil(percent * np.maximum(na, nb), 100) - 1)


def _small_columns(small: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Pairs of different parts from columns with few members; columns with many count as shared here."""
    held = large.groupBy("node").agg(F.count("*").alias("h"))
    rows = small.join(held, "node", "left").fillna(0, ["h"])
    x = rows.where("part <> main").select("key", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"), F.col("h").alias("hx"))
    y = rows.select("key", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("part").alias("py"), F.col("h").alias("hy"), "main")
    product = x.join(y, "key").where("px <> py and (py = main or x < y)").where(_size_fits("nx", "ny", percent))
    counted = product.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.least("nx", "ny").alias("low"), F.greatest("nx", "ny").alias("high"), F.least("hx", "hy").alias("h"))
    asked = F.expr(f"({percent} * (low + high) + {99 + percent}) div {100 + percent} - (({percent} * high + 99) div 100 - 1)")
    return counted.agg(F.count("*").alias("overlap")).where(F.col("overlap") + F.col("h") >= asked).select("a", "b")


def _large_columns(large: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The same from columns with many: members outside the largest part times all, in blocks of rows, each block's product a dense one in numpy."""

    def product(batches):
        key, held = None, []

        def flush():
            x, y = ([r for r in held if r[0] is side] for side in (True, False))
            if not x or not y:
                return
            lengths = np.cumsum([len(r[5]) for r in x])
            ny, nodes, parts = (np.array([r[i] for r in y], np.int64) for i in (3, 2, 4))
            rows, flat = np.repeat(np.arange(len(y)), [len(r[5]) for r in y]), np.concatenate([r[5] for r in y])
            at = 0
            while at < len(x):
                end = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + CELLS, "right")))
                some = x[at:end]
                names, column = np.unique(np.concatenate([r[5] for r in some]), return_inverse=True)
                left = np.zeros((len(some), len(names)), np.float32)
                left[np.repeat(np.arange(len(some)), [len(r[5]) for r in some]), column] = 1
                place = np.minimum(np.searchsorted(names, flat), len(names) - 1)
                own = names[place] == flat
                right = np.zeros((len(y), len(names)), np.float32)
                right[rows[own], place[own]] = 1
                overlap = left @ right.T
                nx, mine, other, main = (np.array([r[i] for r in some], np.int64)[:, None] for i in (3, 2, 4, 1))
                keep = (other != parts) & ((parts == main) | (mine < nodes)) & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))
                i, j = np.nonzero(keep & (overlap >= _asked(nx, ny, percent)))
                a, b = mine[i, 0], nodes[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
                at = end

        for batch in batches:
            blocks = batch.column(8)
            flat, ends = blocks.flatten().to_numpy(), np.cumsum([0, *(len(b) for b in blocks)])
            for i, (k, o, p, *row) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:8]), strict=True)):
                if (k, o, p) != key:
                    yield from flush()
                    key, held = (k, o, p), []
                held.append((*row, flat[ends[i] : ends[i + 1]]))
        yield from flush()

    rows = large.join(classes.select("node", "block"), "node")
    rows = rows.withColumns({"os": F.ceil((F.col("all") - F.col("most")) / ROWS).cast("int"), "ps": F.ceil(F.col("all") / ROWS).cast("int")})
    each = ["main", "node", "n", "part", "block"]
    x = rows.where("part <> main").select("key", F.pmod("node", "os").cast("int").alias("o"), F.explode(F.expr("sequence(0, ps - 1)")).alias("p"), F.lit(True).alias("x"), *each)
    y = rows.select("key", F.explode(F.expr("sequence(0, os - 1)")).alias("o"), F.pmod("node", "ps").cast("int").alias("p"), F.lit(False).alias("x"), *each)
    dealt = x.unionByName(y).repartition("key", "o", "p").sortWithinPartitions("key", "o", "p")
    return dealt.mapInArrow(product, "a long, b long")


def ngram_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, scratch: list[DataFrame] | None = None) -> DataFrame:
    """``doc_id, tk, n_shingles, root, component_id`` per row of ``docs``; tk hashes its text, root names its component.

    Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    word n-grams (A-Z lower-cased; fewer than n words: the whole sequence as one).  A null or
    wordless text has the empty set and links with nothing.  component_id is the smallest doc_id
    reachable; null ids are ignored in that minimum and keep their row.  Repeated rows are copies.
    ``scratch`` takes the written tables that the result still reads.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be in (50, 100]")
    modest_batches(docs.sparkSession)
    rows = written(_incidence(docs, doc_id, text, n, percent), "incidence")
    classes = written(
        rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("tk").alias("tk"), F.first("n").alias("n"), F.first("block").alias("block")),
        "classes",
    )
    # counts are combined before they travel and written before they are joined, so that a column
    # with very many members is split between tasks
    members = classes.select(F.explode("block").alias("key"), "node", "n")
    counts = written(members.groupBy("key").count().where("count > 1"), "counts")
    shared = written(members.join(counts, "key"), "columns")

    # the members that share most with others lead a crowded column: near copies hang on to them
    crowded = shared.where(F.col("count") > LEADERS)
    weight = written(crowded.groupBy("node").agg(F.sum("count").alias("weight")), "weights")
    central = Window.partitionBy("key").orderBy(F.desc("weight"), "node")
    # each task passes on at most so many of a column
    ranked = crowded.join(weight, "node").withColumn("rank", F.row_number().over(central)).where(F.col("rank") <= LEADERS)
    leaders = written(ranked.select("key", F.col("node").alias("a"), F.col("n").alias("na")), "leaders")
    late = crowded.select("key", F.col("node").alias("b"), F.col("n").alias("nb")).join(leaders.select("key", F.col("a").alias("b")), ["key", "b"], "left_anti")
    star = late.join(leaders, "key").where(_size_fits("na", "nb", percent)).select("a", "b").distinct()
    near = _overlapping(star, classes, docs, text, n, percent)
    parts = components(near).withColumnsRenamed({"root": "part"})

    everyone = written(shared.drop("count").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")), "parts")
    sizes = everyone.groupBy("key", "part").count().groupBy("key")
    sizes = sizes.agg(F.max_by("part", F.struct("count", "part")).alias("main"), F.max("count").alias("most"), F.sum("count").alias("all"), F.count("*").alias("parts"))
    open_ = written(everyone.join(sizes.where("parts > 1").drop("parts"), "key"), "open")
    forget(counts, shared, weight, leaders, everyone)
    small, large = open_.where(F.col("all") <= LEADERS), open_.where(F.col("all") > LEADERS)
    pairs = _small_columns(small, large, percent).unionByName(_large_columns(large, classes, percent)).distinct()
    far = _overlapping(pairs, classes, docs, text, n, percent)

    roots = components(near.unionByName(far))  # checkpointed
    forget(open_, near, far)
    if scratch is not None:
        scratch += [rows, classes]
    joined = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = joined.select("node", "root").join(smallest, "root").select("node", "root", "component_id")
    out = rows.select("doc_id", "tk", "node", F.col("n").alias("n_shingles")).join(named, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "tk", "n_shingles", "root", own.alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one row of each component of ``ngram_groups``: the smallest id, and of rows with that id the one whose text hashes lowest.

    Rows without words are in no component and all stay.
    """
    scratch: list[DataFrame] = []
    groups = written(ngram_groups(docs, doc_id, text, n, percent, scratch).where("n_shingles > 0").select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk").alias("row"), "root"), "groups")
    forget(*scratch)
    first = groups.groupBy("root").agg(F.min("row").alias("first"))
    others = groups.join(first, "root").where("row <> first").select("row").distinct()
    repeats = groups.groupBy("row").count().where("count > 1").select("row")
    rows = docs.withColumn("_row", F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tk")))
    rows = rows.join(bounded_broadcast(others.withColumnRenamed("row", "_row")), "_row", "left_anti")
    repeats = bounded_broadcast(repeats.withColumnRenamed("row", "_row"))
    alone = rows.join(repeats, "_row", "left_anti")
    return alone.unionByName(rows.join(repeats, "_row", "left_semi").dropDuplicates(["_row"])).drop("_row")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
