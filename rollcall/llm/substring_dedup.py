"""Substring dedup (op3): level-wise doubling of repeated word windows.

A window of 35 words that occurs twice holds shorter windows that occur twice.  So the levels
run over window lengths 9, 18, 35 (each at most twice the one before): windows that are repeated
at one length alone are extended, to the right or to the left, to the next; the rest can't be
part of any longer repeat and go.  It ends when no candidate survives or the asked length is done.

* The first level looks at one window of 9 words in every 35: the leftmost one with the smallest
  hash.  Equal windows of 35 words hold the same one at the same place, so none is lost.
* Between levels the repeated hashes are kept as a bit table of fixed size (``FILTER_BITS``,
  16 MB, broadcast).  Its false positives only let through candidates that the next level drops.
* The last level is exact: candidates are counted by hash and joined back.
* Copies of a whole text are found first, by a hash of the text.  One of them stands for all.

Windows and texts are named by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, modest_batches, table, written
from rollcall.llm.textvec import U, Windows, Words, chunks, frugal, leftmost_minima
from rollcall.session import bounded_broadcast

WINDOW = 35
BASE = 9
FILTER_BITS = 27
ROWS = 512  # texts that a task holds in cut form at a time


def levels(window: int, base: int) -> list[int]:
    """Window lengths from ``base``, doubled until ``window`` is reached."""
    lengths = [min(base, window)]
    while lengths[-1] < window:
        lengths.append(min(2 * lengths[-1], window))
    return lengths


def _flagged(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> U(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Candidates:
    """Windows of a chunk that every level so far lets through."""

    def __init__(self, words: Words, lengths: list[int], filters: list[np.ndarray]):
        self.base, self.window, self.first = lengths[0], lengths[-1], words.first
        self.hashed = Windows(words.hashes())
        self.starts = np.flatnonzero(self.hashed.valid(words.first, self.window))
        smallest = self.hashed.hashes(self.base)
        smallest[~self.hashed.valid(words.first, self.base)] = ~U(0)
        self.anchors = leftmost_minima(smallest, self.window - self.base + 1)[self.starts]
        for length, bits in zip(lengths, filters, strict=False):
            keep = _flagged(bits, self.hashed.hashes(length)[self.inner(length)]) if len(self.starts) else np.zeros(0, bool)
            self.starts, self.anchors = self.starts[keep], self.anchors[keep]

    def inner(self, length: int) -> np.ndarray:
        """Start of the window of ``length`` words about each candidate's anchor, extended right where that fits, else left."""
        right = self.anchors + length <= self.starts + self.window
        return np.where(right, self.anchors, np.maximum(self.anchors + self.base - length, self.starts))


def _bits(rows: DataFrame) -> np.ndarray | None:
    """The bit table of hashes ``h`` that occur twice or more (by weight ``w``); None where there is none."""
    many = rows.groupBy("h").agg(F.sum("w").alias("c")).where("c > 1")
    at = many.select(F.expr(f"shiftrightunsigned(h, {64 - FILTER_BITS})").alias("at"))
    at = at.select(F.expr("at div 32768").alias("part"), F.expr("at % 32768").alias("bit"))
    parts = at.repartition(16, "part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    if not parts:
        return None
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for part, bits in parts:  # at most 2**FILTER_BITS / 32768 rows of 4 KB
        whole[part * 4096 : (part + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return whole


def repeated_windows(docs: DataFrame, text: str, window: int, base: int, scratch: list[DataFrame]) -> DataFrame:
    """``(tk, from, to)``: runs of starts of repeated windows in the text hashed to ``tk``, and ``(tk, null, null)`` for texts with copies; ``scratch`` takes the written tables it reads."""
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64(text).alias("tk"), F.col(text).alias("text")).where("text is not null")
    copies = written(keyed.groupBy("tk").agg(F.count("*").alias("c")).where("c > 1").select("tk"), "copies")
    # one row stands for all copies: the row itself isn't known in a scan, so they meet in a map-side combine
    twice = bounded_broadcast(copies)
    alone = keyed.join(twice, "tk", "left_anti").withColumn("w", F.lit(1))
    shared = keyed.join(twice, "tk", "left_semi").groupBy("tk").agg(F.first("text").alias("text")).withColumn("w", F.lit(2))
    shared = written(shared, "copied")
    source = alone.unionByName(shared)
    scratch += [copies, shared]

    lengths, filters = levels(window, base), []
    if any(2 * length > window + 1 + lengths[0] for length in lengths[:-1]):
        raise ValueError("window must be less than about four times base")

    def probe(step: int):
        def run(batches):
            known = [f.value for f in filters[:step]]
            for batch in batches:
                weight = batch.column(2).to_numpy()
                for row, _, data, offsets in chunks(batch.column(1)):
                    found = Candidates(Words(data, offsets), lengths, known)
                    if not len(found.starts):
                        continue
                    inner = np.unique(found.inner(lengths[step]))
                    at = np.searchsorted(found.first, inner, "right") - 1 + row
                    yield pa.RecordBatch.from_arrays([pa.array(found.hashed.hashes(lengths[step])[inner].view(np.int64)), pa.array(weight[at], pa.int32())], ["h", "w"])

        return run

    def last(batches):
        known = [f.value for f in filters]
        for batch in batches:
            keys, weight = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for row, _, data, offsets in chunks(batch.column(1)):
                found = Candidates(Words(data, offsets), lengths, known)
                at = np.searchsorted(found.first, found.starts, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.hashed.hashes(window)[found.starts].view(np.int64)), pa.array(keys[at + row]), pa.array((found.starts - found.first[at]).astype(np.int32)), pa.array(weight[at + row], pa.int32())],
                    ["h", "tk", "pos", "w"],
                )

    def runs(batches):
        """Of rows in order of (tk, pos): runs of consecutive positions; one across batches comes out in parts."""
        for batch in batches:
            keys, pos = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(keys) + 1, bool)
            new[1:-1] = (keys[1:] != keys[:-1]) | (pos[1:] - pos[:-1] > 1)
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(keys[at[:-1]]), pa.array(pos[at[:-1]]), pa.array(pos[at[1:] - 1])], ["tk", "from", "to"])

    whole = copies.select("tk", F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("to"))
    for step in range(len(lengths) - 1):
        bits = _bits(source.mapInArrow(frugal(probe(step)), "h long, w int"))
        if bits is None:
            return whole
        filters.append(spark.sparkContext.broadcast(bits))
    rows = written(source.mapInArrow(frugal(last), "h long, tk long, pos int, w int"), "windows")
    many = written(rows.groupBy("h").agg(F.sum("w").alias("c")).where("c > 1").select("h"), "repeated")
    scratch += [rows, many]
    found = rows.where("w = 1").join(many, "h", "left_semi").select("tk", "pos")
    found = found.repartition("tk").sortWithinPartitions("tk", "pos").mapInArrow(runs, "tk long, from int, to int")
    return whole.unionByName(found)


def dedup_substrings(docs: DataFrame, text: str = "text", window: int = WINDOW, base: int = BASE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of every row with ``n_words``, ``n_removed`` and ``kept``.

    A window is ``window`` consecutive words of one row's text.  A word goes if a window covers it
    whose word sequence starts anywhere else too, in the same text or another row's.  Windows are
    judged on the input.  ``kept`` holds the other words joined by one space.  A null text has no
    words, and kept is empty.  A text shorter than the window is kept whole.  Repeated rows are
    copies of each other.  An empty table gives no rows.
    """
    modest_batches(docs.sparkSession)
    scratch: list[DataFrame] = []
    spans = written(repeated_windows(docs, text, window, base, scratch), "spans")
    forget(*scratch)
    spans = spans.groupBy("tk").agg(F.collect_list("from").alias("_from"), F.collect_list("to").alias("_to"))
    rows = docs.select(F.struct(*carry).alias("_row"), F.col(text).alias("_text"), F.xxhash64(text).alias("tk"))
    rows = rows.join(bounded_broadcast(spans), "tk", "left").select("_row", "_text", "_from", "_to")

    def cut(batches):
        for batch in (b.slice(s, ROWS) for b in batches for s in range(0, b.num_rows, ROWS)):
            counts, removed, kept = [], [], []
            for value, starts, ends in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                words = (value.as_py() or "").encode().split()  # on 0x20 and 0x09-0x0D
                total = len(words)
                if starts.is_valid and total >= window:
                    gone = np.zeros(total, bool)
                    for a, b in zip(starts.as_py(), ends.as_py(), strict=True):
                        gone[a : b + window] = True
                    if not len(starts):  # the whole text has copies
                        gone[:] = True
                    words = [words[i] for i in np.flatnonzero(~gone)]
                counts.append(total)
                removed.append(total - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["_row", "n_words", "n_removed", "kept"],
            )

    row = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(frugal(cut), f"_row {row}, n_words long, n_removed long, kept string")
    return out.select("_row.*", "n_words", "n_removed", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
