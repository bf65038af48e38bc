"""Toxicity (op9): a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct terms of a text: the pairwise
part learns that two terms count together (an insult with a mention of a group) what neither does
alone.  Terms are runs of letters and digits, A-Z lower-cased,
and the first bytes of longer ones, hashed to ``2**BITS`` numbers.

Training takes at most ``SAMPLE`` labelled documents, those whose ids have the smallest hashes (a
stated bound).  Its terms are counted by Spark: the ``ACTIVE`` whose presence differs most between
the labels are kept, and of the terms that stand beside one of these, the ``COMPANY`` whose presence
differs most among such rows, so a term that counts only beside another has its factors too.  Only
these terms of each row go to the one task that learns.  Scoring reads every whole text; the model
has a fixed size and is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, modest_batches, table, written
from rollcall.llm.textvec import Spans, U, Words, chunks, frugal, mix

BITS = 20
STEMS = (5, 6, 7, 8)
SAMPLE = 20_000
ACTIVE = 2048
COMPANY = 1024
LEAST_ROWS = 4
LEAST_SPREAD = 4.5  # standard deviations between a term's rows of label 1 and those expected of it
FACTORS = 8
EPOCHS = 40
BATCH = 64
RATE = 0.2
DECAY = 2e-5
SEED = 11
THRESHOLD = 0.3


def _letters() -> np.ndarray:
    """Bytes that make up terms, lower-cased; all others become spaces."""
    to = np.full(256, 32, np.uint8)
    to[128:] = np.arange(128, 256)
    for low, high in ((48, 57), (97, 122)):
        to[low : high + 1] = np.arange(low, high + 1)
    to[65:91] = np.arange(97, 123)
    return to


def terms(column: pa.Array):
    """``(first row, rows, row of each term, number of each term)`` of each chunk: its words, and their first ``STEMS`` bytes, which inflected forms share."""
    to = _letters()
    for row, end, data, offsets in chunks(column):
        words = Words(to[data], offsets)
        spans = Spans(words.data)
        of = np.repeat(np.arange(end - row), words.counts())
        rows, hashes = [of], [spans.hashes(words.starts, words.ends)]
        for length in STEMS:
            longer = words.ends - words.starts > length
            starts = words.starts[longer]
            rows.append(of[longer])
            hashes.append(mix(spans.hashes(starts, starts + length) + U(length)))
        yield row, end - row, np.concatenate(rows), (np.concatenate(hashes) >> U(64 - BITS)).astype(np.int64)


class Machine:
    """``active``: the model's place of each hashed term, -1 for none."""

    def __init__(self, active: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.active, self.bias, self.linear, self.factors = active, bias, linear, factors

    def scores(self, rows: int, row: np.ndarray, number: np.ndarray) -> np.ndarray:
        place = self.active[number]
        known = place >= 0
        row, place = np.divmod(np.unique(row[known] * len(self.linear) + place[known]), max(len(self.linear), 1))
        raw = self.bias + np.bincount(row, self.linear[place], rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[place, f]
            raw += (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows)) / 2
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def train(labels: np.ndarray, places: list[np.ndarray], size: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors of ``size`` terms, fitted on rows of distinct terms and both labels."""
    rows, ones = len(labels), int(labels.sum())
    bias = float(np.log((ones + 1) / (rows - ones + 1)))
    random = np.random.default_rng(SEED)
    linear, factors = np.zeros(size), random.normal(0, 0.01, (size, FACTORS))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(rows)
        for s in range(0, rows, BATCH):
            batch = order[s : s + BATCH]
            place = np.concatenate([places[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(places[i]) for i in batch])
            v = factors[place]
            sums = np.stack([np.bincount(row, v[:, f], len(batch)) for f in range(FACTORS)], 1)
            squares = np.bincount(row, (v * v).sum(1), len(batch))
            raw = bias + np.bincount(row, linear[place], len(batch)) + ((sums**2).sum(1) - squares) / 2
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]
            g = error[row]
            grad_w = np.bincount(place, g, size) / len(batch) + DECAY * linear
            pull = g[:, None] * (sums[row] - v)
            grad_v = np.stack([np.bincount(place, pull[:, f], size) for f in range(FACTORS)], 1) / len(batch) + DECAY * factors
            grad_b = error.mean()
            seen_w += grad_w**2
            seen_v += grad_v**2
            seen_b += grad_b**2
            linear -= RATE * grad_w / np.sqrt(seen_w)
            factors -= RATE * grad_v / np.sqrt(seen_v) / 4
            bias -= RATE * grad_b / np.sqrt(seen_b)
    return bias, linear, factors


def _telling(rows: DataFrame, beside: np.ndarray | None, most: int) -> np.ndarray:
    """The at most ``most`` terms of ``label, terms`` rows whose presence differs most between the labels; ``beside``: among rows that hold one of these, others than these."""

    def count(batches):
        for batch in batches:
            labels, lists = batch.column(0).to_numpy(), [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
            if beside is not None:
                held = [i for i, x in enumerate(lists) if np.isin(x, beside).any()]
                labels, lists = labels[held], [lists[i] for i in held]
            if not lists:
                continue
            flat, of = np.concatenate(lists), np.repeat(labels, [len(x) for x in lists])
            # the number -1 counts the rows themselves
            number, which = np.unique(np.concatenate([np.full(len(labels), -1, np.int32), flat]), return_inverse=True)
            of = np.concatenate([labels, of])
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.bincount(which, minlength=len(number))), pa.array(np.bincount(which, of, len(number)).astype(np.int64))], ["number", "n", "ones"])

    sums = rows.mapInArrow(count, "number int, n long, ones long").groupBy("number").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).checkpoint()
    all_ = sums.where("number = -1").first()
    if all_ is None or all_["ones"] in (0, all_["n"]):
        return np.zeros(0, np.int64)
    share = (F.col("n") + 1) / (all_["n"] + 2)
    spread = F.abs(F.col("ones") - share * all_["ones"]) / F.sqrt(share * (1 - share) * all_["ones"])
    told = sums.where(F.col("number") >= 0).where(F.col("n") >= LEAST_ROWS).withColumn("spread", spread).where(F.col("spread") >= LEAST_SPREAD)
    if beside is not None:
        told = told.where(~F.col("number").isin(beside.tolist()))
    return np.array([r["number"] for r in told.orderBy(F.desc("spread"), "number").limit(most).collect()], np.int64)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Machine:
    """Train on the sample of ``labels`` (``doc_id, label``) with their texts in ``docs``.

    Null labels and ids are left out.  An id labelled several times counts once, with its largest
    label; one that ``docs`` holds several times gives the smallest of its texts.  Null and empty
    texts hold no terms.  Of several terms that differ alike, those of the smallest numbers are
    taken.  Without rows of both labels, also without any, every score is the share of label 1.
    """
    modest_batches(docs.sparkSession)
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)  # kept as one top-k of each task

    def distinct(batches):
        for batch in batches:
            column = batch.column(1)
            for first, rows, row, number in terms(column):
                both = np.unique(row << BITS | number)
                lists = np.split((both & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(both >> BITS, np.arange(1, rows)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first : first + rows], pa.array([x.tobytes() for x in lists], pa.binary())], ["label", "terms"])

    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")  # SAMPLE rows
    texts = texts.groupBy("_id").agg(F.first("_label").alias("_label"), F.min("_text").alias("_text"))
    rows = written(texts.select("_label", "_text").mapInArrow(frugal(distinct), "label int, terms binary"), "terms")
    alone = _telling(rows, None, ACTIVE)
    chosen = np.sort(np.concatenate([alone, _telling(rows, alone, COMPANY)]) if len(alone) else alone)
    active = np.full(1 << BITS, -1, np.int64)
    active[chosen] = np.arange(len(chosen))
    count = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).first()
    if count["ones"] in (0, count["n"]):
        return Machine(active, float(np.log((count["ones"] + 1) / (count["n"] - count["ones"] + 1))), np.zeros(0), np.zeros((0, FACTORS)))

    def cut(batches):
        for batch in batches:
            lists = [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
            held = [np.searchsorted(chosen, x[np.isin(x, chosen)]).astype(np.int32).tobytes() for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], ["label", "places"])

    def learn(batches):
        held = sorted((label, places) for batch in batches for label, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        bias, linear, factors = train(np.array([r[0] for r in held], np.int64), [np.frombuffer(r[1], np.int32).astype(np.int64) for r in held], len(chosen))
        yield pa.RecordBatch.from_pylist([{"bias": bias, "linear": linear.tobytes(), "factors": factors.tobytes()}])

    # SAMPLE rows of at most ACTIVE + COMPANY terms: the one task that learns from them is bounded
    model = rows.mapInArrow(cut, "label int, places binary").repartition(1).mapInArrow(learn, "bias double, linear binary, factors binary").first()
    forget(rows)
    return Machine(active, model["bias"], np.frombuffer(model["linear"]), np.frombuffer(model["factors"]).reshape(len(chosen), FACTORS))


def score(docs: DataFrame, machine: Machine, doc_id: str, text: str) -> DataFrame:
    """``doc_id, score`` for every row; a null text scores like an empty one."""
    model = docs.sparkSession.sparkContext.broadcast((machine.active, machine.bias, machine.linear, machine.factors))

    def run(batches):
        machine = Machine(*model.value)
        for batch in batches:
            for first, rows, row, number in terms(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[first : first + rows], pa.array(machine.scores(rows, row, number))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(frugal(run), "doc_id long, score double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit(docs, labels.where(~held_out(F.col("doc_id"))), "doc_id", "text", "toxic")
    scored = score(docs, machine, "doc_id", "text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
