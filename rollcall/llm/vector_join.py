"""Embedding near-dedup (op6): spherical-cap filters from structured random product codes.

Vectors are turned by a random rotation and cut into two blocks.  Each block has a code of random
unit vectors; a filter direction is a pair of code words, so a vector's inner products with all
directions are sums of two short lists.  List decoding sorts both and reads off exactly the pairs
whose sum exceeds the cap height, or its nearest ``LEAST`` where those are fewer.  Vectors meet in
the filters they share, and every met pair is verified by its cosine in double precision.

Size and height follow from the number of vectors of a length (``designed``): about ``IN_CAP``
vectors to a filter, ``FILTERS`` filters to a vector or more, as the wanted recall needs.  Equal
vectors are one class beforehand.  A filter with more than
``BLOCK`` vectors is dealt out over pairs of parts, so no task holds it whole; each task returns
one row per vector with its number of links and one link that keeps its component together, never
all pairs.  A pair that shares several filters is counted in the smallest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.components import components
from rollcall.llm.store import modest_batches, table, written
from rollcall.session import bounded_broadcast

COSINE = 0.9
FILTERS = 48
LEAST = 32  # a vector near few directions takes at least so many, its nearest
WANTED, TRIED = 0.99, 512  # share of pairs at the very limit that are to meet, of so many random ones
SLICE = 1 << 12  # filters compared at a time
IN_CAP = 8
BLOCK = 1024
SEED = 7


class Code:
    """The rotation and code words for vectors of ``dim`` components; ``words`` of them to a block."""

    def __init__(self, dim: int, words: int, height: float):
        self.words, self.height = words, height
        self.least = min(LEAST, words * words)
        random = np.random.default_rng([SEED, dim])
        self.rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
        self.cut = max(1, dim // 2)
        self.blocks = []
        for size in (self.cut, dim - self.cut):
            each = random.standard_normal((words, size))
            self.blocks.append(each / np.maximum(np.linalg.norm(each, axis=1, keepdims=True), 1e-12) / math.sqrt(2) if size else each)

    def products(self, units: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per unit vector its inner products with the words of either block."""
        step = max(1, min(512, (1 << 22) // self.words))
        for s in range(0, len(units), step):
            turned = units[s : s + step] @ self.rotation
            yield from zip(turned[:, : self.cut] @ self.blocks[0].T, turned[:, self.cut :] @ self.blocks[1].T, strict=True)

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """Per unit vector, the sorted numbers of all filters whose direction it exceeds the height with."""
        found = []
        for x, y in self.products(units):
            near, far = np.flatnonzero(x >= self.height - y.max()), np.flatnonzero(y >= self.height - x.max())
            far = far[np.argsort(-y[far])]
            counts = np.searchsorted(-y[far], x[near] - self.height, "right")
            i = np.repeat(near, counts)
            j = far[np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)]
            if len(i) < self.least:  # the best sums lie among as many best of either block
                rows, columns = np.argsort(-x)[: self.least], np.argsort(-y)[: self.least]
                sums = (x[rows][:, None] + y[columns][None, :]).ravel()
                top = np.argpartition(-sums, self.least - 1)[: self.least]
                i, j = rows[top // len(columns)], columns[top % len(columns)]
            found.append(np.sort(i * self.words + j))
        return found

    def calibrate(self, units: np.ndarray, filters: float) -> None:
        """The height that ``filters`` of the directions exceed on average, measured on ``units``."""
        sums = [(x, np.sort(-y)) for x, y in self.products(units)]
        low, high = 0.0, max(x.max() - y[0] for x, y in sums) + 1e-9
        for _ in range(40):
            height = (low + high) / 2
            count = sum(int(np.searchsorted(y, x[x >= height + y[0]] - height, "right").sum()) for x, y in sums)
            low, high = (height, high) if count >= filters * len(sums) else (low, height)
        self.height = high


def pairs_at(cosine: float, count: int, dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors, and one at that cosine of each."""
    random = np.random.default_rng([seed, dim, count])
    a, b = unit(random.standard_normal((count, dim))), random.standard_normal((count, dim))
    if dim == 1:
        return a, a
    b = unit(b - (a * b).sum(1, keepdims=True) * a)
    return a, cosine * a + math.sqrt(1 - cosine * cosine) * b


def recall(code: Code, a: np.ndarray, b: np.ndarray) -> float:
    """The share of pairs that meet in a filter."""
    return float(np.mean([len(np.intersect1d(x, y, assume_unique=True)) > 0 for x, y in zip(code.decode(a), code.decode(b), strict=True)]))


def designed(dim: int, vectors: int, cosine: float = COSINE) -> tuple[int, float]:
    """Words of a block and cap height for a table of so many vectors.

    About ``IN_CAP`` unrelated vectors are in a filter.  The height is measured on the code itself,
    and a vector takes as many filters as let ``WANTED`` of random pairs at exactly ``cosine`` meet:
    the rotation is random, so a pair of any table is such a pair.  Up to ``BLOCK`` vectors share
    one filter, where all meet.
    """
    if vectors <= BLOCK:
        return 1, -math.inf
    cap, (a, b) = min(5e-3, IN_CAP / vectors), pairs_at(cosine, TRIED, dim, SEED)
    filters = float(FILTERS)
    while True:
        code = Code(dim, math.ceil(math.sqrt(filters / cap)), 0.0)
        code.calibrate(a[:128], filters)
        if recall(code, a, b) >= WANTED or filters > 64 * FILTERS:
            return code.words, code.height
        filters *= 1.25


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _blocks(part: np.ndarray, units: np.ndarray, lists: list[np.ndarray], at: int, cross: bool, weight: np.ndarray, cosine: float):
    """Links inside one filter (or between two parts of it): per vector its number of links first met here, and the smallest vector it hangs together with."""
    links = units @ units.T >= cosine
    np.fill_diagonal(links, False)
    if cross:
        links &= part[:, None] != part[None, :]
    if not links.any():
        return None
    label = np.arange(len(units))
    while True:
        lower = np.minimum(label, np.where(links, label[None, :], len(units)).min(1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.concatenate(lists)
    before = flat < at
    names, column, count = np.unique(flat[before], return_inverse=True, return_counts=True)
    shared = count > 1  # a filter of one member says nothing about pairs
    place = np.cumsum(shared) - 1
    rows, column = rows[before][shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    first = links
    for low in range(0, int(shared.sum()), SLICE):
        a, b = np.searchsorted(column, [low, low + SLICE])
        met = np.zeros((len(lists), min(SLICE, int(shared.sum()) - low)), np.float32)
        met[rows[a:b], column[a:b] - low] = 1
        first = first & (met @ met.T == 0)
    return first @ weight, label, links.any(1)


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row.

    Links with cosine of at least ``cosine`` are found, none below it.  A vector that is null, empty
    or zero, or holds null or non-finite components, links with nothing, and neither do vectors of
    different lengths.  Null ids are ignored in component_id.  Repeated rows link with each other.
    No rows give no rows.
    """
    modest_batches(vectors.sparkSession)
    values = F.col(embedding).cast("array<double>")
    good = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(good, values).alias("v"))
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    classes = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("w"), F.first("v").alias("v"))
    classes = written(classes, "vectors")
    lengths = classes.groupBy(F.size("v").alias("dim")).count().where(F.col("count") > BLOCK).collect()  # one row a length
    design = {r["dim"]: designed(r["dim"], r["count"], cosine) for r in lengths}

    kind = np.float32 if isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType) else np.float64
    number = np.int32 if max((words for words, _ in design.values()), default=1) ** 2 < 1 << 31 else np.int64

    def caps(batches):
        codes: dict[int, Code] = {}
        for batch in batches:
            whole, nodes, weights = batch.column(2), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat, ends = whole.flatten().to_numpy(), np.cumsum([0, *(len(x) for x in whole)])
            dims = np.diff(ends)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                code = codes.get(dim) or codes.setdefault(dim, Code(dim, *design.get(dim, (1, -math.inf))))
                for s in range(0, len(at), 512):
                    each = np.stack([flat[ends[i] : ends[i + 1]] for i in at[s : s + 512]])
                    lists = code.decode(unit(each))
                    own = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                    held, sent = [v.astype(kind).tobytes() for v in each], [x.astype(number).tobytes() for x in lists]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), dim, np.int32)), pa.array(np.concatenate(lists), pa.int64()), pa.array(nodes[at[s + own]]), pa.array(weights[at[s + own]]),
                         pa.array([held[i] for i in own], pa.binary()), pa.array([sent[i] for i in own], pa.binary())],
                        ["dim", "cap", "node", "w", "v", "caps"],
                    )

    def sizes(batches):
        for batch in caps(batches):
            yield batch.select(["dim", "cap"])

    def verify(batches):
        held: list = []
        key = None

        def flush():
            if len(held) < 2:
                return None
            dim, cap, p, q = key
            nodes = np.array([r[0] for r in held], np.int64)
            units = unit(np.frombuffer(b"".join(r[2] for r in held), kind).reshape(len(held), dim).astype(np.float64))
            part = np.array([r[4] for r in held])
            out = _blocks(part, units, [np.frombuffer(r[3], number) for r in held], cap, p != q, np.array([r[1] for r in held], np.int64), cosine)
            if out is None:
                return None
            links, label, any_ = out
            return pa.RecordBatch.from_arrays([pa.array(nodes[any_]), pa.array(links[any_].astype(np.int64)), pa.array(nodes[label[any_]])], ["node", "links", "with"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for dim, cap, p, q, node, w, v, names, part in zip(*columns, strict=True):
                if (dim, cap, p, q) != key:
                    out = flush()
                    if out is not None:
                        yield out
                    held, key = [], (dim, cap, p, q)
                held.append((node, w, v, names, part))
        out = flush()
        if out is not None:
            yield out

    source = classes.select("node", "w", "v")
    met = source.mapInArrow(caps, "dim int, cap long, node long, w long, v binary, caps binary")
    crowded = source.mapInArrow(sizes, "dim int, cap long").groupBy("dim", "cap").count().where(F.col("count") > BLOCK).select("dim", "cap", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    met = met.join(bounded_broadcast(crowded), ["dim", "cap"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    met = met.withColumn("part", F.pmod("node", "parts").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    met = met.select("dim", "cap", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "node", "w", "v", "caps", "part")
    met = met.repartition("dim", "cap", "p", "q").sortWithinPartitions("dim", "cap", "p", "q")
    found = written(met.mapInArrow(verify, "node long, links long, with long"), "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("with").alias("b")))
    named = classes.select("node", "vec_id", "w").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    named = named.join(smallest, "root").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    out = rows.select("vec_id", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
