"""Language-model scoring (op11): Brown's class-based n-grams.

Exchange clustering assigns words to classes; the probability of a word is that of its class after
what came before, times that of the word within its class.

* All training words are counted.  The ``HEAD`` most frequent ones (and the end of a text) are the
  *head*, whose names and classes go to every task: their number is a parameter, so that table is
  of bounded size.  Rarer words are met by joins, and no rare word holds more than one part in
  ``HEAD`` of the text, so those joins have no hot key.
* The head is clustered by exchange.  A round takes the counts between classes, finds for every word
  the class that raises the likelihood of the class bigrams most, and moves one half of the words
  (by hash), since words moved together don't see each other.  The best round's classes stay.  A
  word's contexts are one row of at most two entries a head word, written once; rounds shuffle
  nothing, and only a class number a head word and the counts between classes reach the driver.
* Every rarer word is then exchanged into the class that makes its contexts likeliest.
* What came before is the class of the nearest earlier head word, and whether rarer words stand in
  between.  The class of unknown words is as likely after it as a word seen once was in training,
  all classes are smoothed with their overall shares, and known words share what is left, so that
  the probabilities of all known words and of "an unknown word" add up to one.

Words are named by 64-bit hashes.  A null text is empty, and an empty text is one token, its end.  A null
id is in training.  Rows with equal ids are scored each on its own, other columns are not
looked at, and an empty table (or one without training rows, where an unknown word is certain) gives
no rows (or scores of 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, modest_batches, table, written
from rollcall.llm.textvec import Words, chunks, frugal, lower_ascii, mix

HEAD, CLASSES, ROUNDS = 1 << 16, 64, 10
PRIOR = 8.0  # tokens' worth of the overall shares of the classes that each history starts with
END = np.uint64(0x5851F42D4C957F2D)  # the end of a text, as a word
FOLDS, HELD_OUT = 5, 1


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def sequences(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, tokens, first)``: an end, then each row's words and its end; row i has ``tokens[first[i]:first[i + 1]]``."""
    for row, end, data, offsets in chunks(column):
        w = Words(lower_ascii(data), offsets)
        first = w.first + np.arange(len(w.first))
        tokens = np.full(first[-1] + 1, END)
        own = np.ones(len(tokens), bool)
        own[0] = own[first[1:]] = False
        tokens[own] = w.hashes()
        yield row, end, tokens, first + 1


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` of all tokens; the hash ``END`` counts the texts."""

    def run(batches):
        for batch in batches:
            for _, _, tokens, _ in sequences(batch.column(0)):
                found, n = np.unique(tokens[1:], return_counts=True)
                yield _table(word=_signed(found), n=n.astype(np.int64))

    return docs.select(text).mapInArrow(frugal(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Head:
    """The most frequent words: ``keys`` sorted, the number of each (0 is the end of a text) and its count by number."""

    keys: np.ndarray
    numbers: np.ndarray
    n: np.ndarray

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Number of each token, -1 for rarer words."""
        at = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        return np.where(self.keys[at] == tokens, self.numbers[at], -1)


def head_words(words: DataFrame, size: int = HEAD) -> Head:
    end = int(_signed(np.array([END]))[0])
    top = words.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(size).collect()  # bounded by ``size``
    texts = words.where(F.col("word") == end).collect()
    hashes = np.array([end] + [r["word"] for r in top], np.int64).view(np.uint64)
    n = np.array([texts[0]["n"] if texts else 0] + [r["n"] for r in top], np.int64)
    order = np.argsort(hashes)
    return Head(hashes[order], order.astype(np.int64), n)


def head_contexts(docs: DataFrame, head: Head, text: str = "text") -> DataFrame:
    """One row per head word: its neighbours (``other``, plus the head's size where it stands before the word) and their counts."""
    size = len(head.n)
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        head = shared.value
        for batch in batches:
            for _, _, tokens, _ in sequences(batch.column(0)):
                number = head.find(tokens)
                both = (number[:-1] >= 0) & (number[1:] >= 0)
                pair, n = np.unique(number[:-1][both] * size + number[1:][both], return_counts=True)
                yield _table(pair=pair, n=n.astype(np.int64))

    pairs = docs.select(text).mapInArrow(frugal(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    left, right = F.expr(f"pair div {size}"), F.expr(f"pair % {size}")
    sides = F.array(F.struct(left.alias("w"), right.alias("other"), "n"), F.struct(right.alias("w"), (left + size).alias("other"), "n"))
    each = pairs.select(F.explode(sides).alias("s")).select("s.*")
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # the rounds' tasks are as many
    return each.repartition(parts, "w").groupBy("w").agg(F.collect_list(F.struct("other", "n")).alias("c")).select("w", F.col("c.other").alias("other"), F.col("c.n").alias("n"))


def _logs(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(between: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what doesn't depend on the classes."""
    between = between.astype(float)
    return float(_logs(between).sum() - _logs(between.sum(0)).sum() - _logs(between.sum(1)).sum())


def best_classes(between: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the class it does best in, and what the likelihood gains there over its own class.

    Row i of ``after`` and ``before`` holds word i's neighbours by class, without itself; ``itself`` is how
    often it follows itself.  Only the cells between its neighbours' classes and the class tried change.
    """
    words, classes = after.shape
    each = np.arange(words)

    def side(m: np.ndarray, near: np.ndarray, other: np.ndarray) -> np.ndarray:
        """What the rows of ``m`` gain by the word's neighbours ``near``; the word itself is taken out of its own class first."""
        row, c = np.nonzero(near)
        if not len(row):
            return np.zeros((words, classes))
        add = near[row, c]
        cells = m[:, c].T.copy()
        at, entry = own[row], np.arange(len(row))
        cells -= np.where((c == at)[:, None], other[row], 0)
        cells[entry, at] -= add + np.where(c == at, itself[row], 0)
        change = _logs(cells + add[:, None]) - _logs(cells)
        out = np.zeros((words, classes))
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[first]] = np.add.reduceat(change, first, axis=0)
        return out

    gain = side(between, after, before) + side(between.T, before, after)
    cell = np.repeat(np.diagonal(between)[None], words, 0)
    rows, cols = (np.repeat(between.sum(k)[None], words, 0) for k in (1, 0))  # a class's total holds its neighbours' in any case
    cell[each, own] -= after[each, own] + before[each, own] + itself
    rows[each, own] -= after.sum(1) + itself
    cols[each, own] -= before.sum(1) + itself
    gain += _logs(cell + after + before + itself[:, None]) + _logs(cell) - _logs(cell + after) - _logs(cell + before)
    leaving, coming = (after.sum(1) + itself)[:, None], (before.sum(1) + itself)[:, None]
    gain -= _logs(rows + leaving) - _logs(rows) + _logs(cols + coming) - _logs(cols)
    best = gain.argmax(1)
    return best, gain[each, best] - gain[each, own]


def _by_class(batch: pa.RecordBatch, cls: np.ndarray, classes: int):
    """Per word of the batch its neighbours by class, after it and before it, and how often it follows itself."""
    w = batch.column(0).to_numpy()
    lengths = np.diff(batch.column(1).offsets.to_numpy())
    other, n = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(float)
    row = np.repeat(np.arange(len(w)), lengths)
    back = other >= len(cls)
    other = np.where(back, other - len(cls), other)
    same = other == w[row]
    sums = [np.bincount(row[k] * classes + cls[other[k]], n[k], len(w) * classes).reshape(len(w), classes) for k in (~back & ~same, back & ~same)]
    return w, sums[0], sums[1], np.bincount(row[same & ~back], n[same & ~back], len(w))


def between_classes(contexts: DataFrame, cls: np.ndarray, classes: int) -> np.ndarray:
    """How often a head word of one class directly follows one of another: ``[before, after]``."""
    shared = contexts.sparkSession.sparkContext.broadcast(cls)

    def count(batches):
        total = np.zeros((classes, classes))
        for batch in batches:
            w, after, _, itself = _by_class(batch, shared.value, classes)
            np.add.at(total, shared.value[w], after)
            np.add.at(total, (shared.value[w], shared.value[w]), itself)
        at = np.flatnonzero(total)
        yield _table(cell=at, n=total.reshape(-1)[at].astype(np.int64))

    out = np.zeros(classes * classes)
    for r in contexts.mapInArrow(frugal(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # bounded by the classes
        out[r["cell"]] = r["n"]
    return out.reshape(classes, classes)


def exchange(contexts: DataFrame, head: Head, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of every head word, and the counts between classes.

    At first the most frequent words have one each, and all others share the last.  All words move in the first round, in the others one half.
    """
    order = np.lexsort((np.arange(len(head.n)), -head.n))
    cls = np.full(len(head.n), classes - 1, np.int64)
    cls[order[: classes - 1]] = np.arange(min(classes - 1, len(order)))
    halves = mix(head.keys[np.argsort(head.numbers)])
    best, kept = -np.inf, (cls, None)
    for turn in range(rounds + 1):
        between = between_classes(contexts, cls, classes)
        if (value := likelihood(between)) > best:
            best, kept = value, (cls, between)
        if turn == rounds:
            return kept
        shared = contexts.sparkSession.sparkContext.broadcast(cls)

        def move(batches, between=between, shared=shared):
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    w, after, before, itself = _by_class(batch.slice(start, 256), shared.value, classes)
                    c, gain = best_classes(between, shared.value[w], after, before, itself)
                    yield _table(w=w.astype(np.int64), c=c, gain=gain)

        moves = contexts.mapInArrow(frugal(move), "w long, c long, gain double").where("gain > 1e-6").select("w", "c").collect()  # at most one a head word
        cls = cls.copy()
        for r in moves:
            if turn == 0 or (int(halves[r["w"]]) >> turn) & 1:
                cls[r["w"]] = r["c"]


def histories(number: np.ndarray, cls: np.ndarray, classes: int) -> np.ndarray:
    """For every token but the first: the class of the nearest head word before it, plus ``classes`` where others stand between."""
    at = np.where(number >= 0, np.arange(len(number)), 0)
    last = np.maximum.accumulate(at)[:-1]
    return cls[number[last]] + classes * (last != np.arange(len(number) - 1))


def rare_words(docs: DataFrame, head: Head, cls: np.ndarray, between: np.ndarray, classes: int, text: str = "text") -> DataFrame:
    """``(kind, key, n, c)``: the rarer words (kind 0) with count and class, the tokens by history and class
    (kind 1, key ``history * classes + class``), and the words seen once by history (kind 2)."""
    shared = docs.sparkSession.sparkContext.broadcast((head, cls))
    width = classes + 1

    def run(batches):
        head, cls = shared.value
        known, once = np.zeros(2 * classes * classes, np.int64), np.zeros(2 * classes, np.int64)
        for batch in batches:
            for _, _, tokens, _ in sequences(batch.column(0)):
                number = head.find(tokens)
                h, number = histories(number, cls, classes), number[1:]
                inside = number >= 0
                known += np.bincount(h[inside] * classes + cls[number[inside]], minlength=len(known))
                once += np.bincount(h[inside][head.n[number[inside]] == 1], minlength=len(once))
                follows = np.append(np.where(inside[1:], cls[number[1:]], classes), classes)
                word, place = _signed(tokens[1:][~inside]), (h * width + follows)[~inside]
                order = np.lexsort((place, word))
                word, place = word[order], place[order]
                new = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (place[1:] != place[:-1])[: len(word)])) if len(word) else np.zeros(0, np.int64)
                yield _table(kind=np.zeros(len(new), np.int32), key=word[new], place=place[new], n=np.diff(np.append(new, len(word))))
        for kind, counts in ((1, known), (2, once)):
            at = np.flatnonzero(counts)
            yield _table(kind=np.full(len(at), kind, np.int32), key=at, place=np.zeros(len(at), np.int64), n=counts[at])

    found = docs.select(text).mapInArrow(frugal(run), "kind int, key long, place long, n long")
    # combined a batch at a time above; dealt by word once, so that neither aggregate moves rows again
    found = found.repartition("kind", "key").groupBy("kind", "key", "place").agg(F.sum("n").alias("n"))
    lists = found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.collect_list(F.struct("place", "n")).alias("p"))
    lists = lists.select("kind", "key", "n", F.col("p.place").alias("place"), F.col("p.n").alias("m"))

    smooth = between + 0.5
    forward = np.log(smooth / smooth.sum(1, keepdims=True))  # forward[c, d]: d after c
    share = np.log(smooth.sum(0))
    # a history with other words between says no more than the overall shares
    to_class = np.vstack([forward, np.broadcast_to(share - np.log(smooth.sum()), forward.shape)])

    def assign(batches):
        known, once = np.zeros(2 * classes * classes, np.int64), np.zeros(2 * classes, np.int64)
        for batch in batches:
            kind, key, n = (batch.column(i).to_numpy() for i in range(3))
            lengths = np.diff(batch.column(3).offsets.to_numpy())
            place, m = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            rows = np.repeat(np.arange(len(key)), lengths)
            before = np.bincount(rows * 2 * classes + place // width, m, len(key) * 2 * classes).reshape(len(key), -1)
            after = np.bincount(rows * width + place % width, m, len(key) * width).reshape(len(key), -1)[:, :classes]
            best = (before @ to_class + after @ forward.T - n[:, None] * share).argmax(1)
            word = kind == 0
            rare = word[rows]
            known += np.bincount((place // width * classes + best[rows])[rare], m[rare], len(known)).astype(np.int64)
            once += np.bincount((place // width)[rare & (n[rows] == 1)], minlength=len(once))
            yield _table(kind=kind, key=key, n=n, c=np.where(word, best, -1).astype(np.int32))
        for k, counts in ((1, known), (2, once)):
            at = np.flatnonzero(counts)
            yield _table(kind=np.full(len(at), k, np.int32), key=at, n=counts[at], c=np.full(len(at), -1, np.int32))

    return lists.mapInArrow(frugal(assign), "kind int, key long, n long, c int")


@dataclass
class Model:
    """What scoring needs: the head, its classes, ``log10`` of class (last: unknown) after history, and tokens by class."""

    head: Head
    cls: np.ndarray
    follows: np.ndarray
    size: np.ndarray
    tokens: int
    types: int


def smoothed(known: np.ndarray, once: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Probabilities of class (last: unknown) after each history, from tokens by history and class and words seen once by history."""
    counts = np.hstack([known, once[:, None]]).astype(float)
    overall = counts.sum(0) + 0.5 * (counts.sum(0) > 0)
    overall[-1] += 0.5
    overall /= overall.sum()
    return (counts + prior * overall) / (counts.sum(1, keepdims=True) + prior)


def fit(docs: DataFrame, text: str = "text", head_size: int = HEAD, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of all ``docs``, and the written table of its rarer words ``(key, n, c)``."""
    words = written(count_words(docs, text), "lm-words")
    tokens, types = words.agg(F.sum("n"), F.count("*")).first()
    head = head_words(words, head_size)
    contexts = written(head_contexts(docs, head, text), "lm-contexts")
    cls, between = exchange(contexts, head, classes, rounds)
    rare = written(rare_words(docs, head, cls, between, classes, text), "lm-rare")
    known, once = np.zeros(2 * classes * classes), np.zeros(2 * classes)
    for r in rare.where("kind > 0").groupBy("kind", "key").agg(F.sum("n").alias("n")).collect():  # bounded by the classes
        (known if r["kind"] == 1 else once)[r["key"]] = r["n"]
    known = known.reshape(2 * classes, classes)
    forget(words, contexts)
    return Model(head, cls, np.log10(np.maximum(smoothed(known, once), 1e-300)), known.sum(0), tokens or 0, types or 0), rare


def score(docs: DataFrame, model: Model, rare: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: its id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    classes = model.follows.shape[1] - 1
    shared = spark.sparkContext.broadcast(model)
    whole = model.tokens + 0.5 * (model.types + 1)
    item = "array<struct<word: long, h: int, m: int>>"

    def run(batches):
        model = shared.value
        size = np.log10(np.maximum(model.size, 1))
        base = np.log10((model.head.n + 0.5) / whole)
        inner = np.log10(np.maximum(model.head.n, 1)) - size[model.cls]
        if not model.tokens:  # nothing was learned: even the end of a text is unknown
            inner = np.zeros(len(model.cls))
        for batch in batches:
            for row, end, tokens, first in sequences(batch.column(2)):
                number = model.head.find(tokens)
                h, number, starts = histories(number, model.cls, classes), number[1:], first - 1
                inside = number >= 0
                own = np.where(inside, number, 0)
                column = model.cls[own] if model.tokens else np.full(len(own), classes)
                sums = []
                for values in (np.where(inside, base[own], 0.0), np.where(inside, model.follows[h, column] + inner[own], 0.0), inside * 1.0):
                    total = np.append(0.0, np.cumsum(values))
                    sums.append(total[starts[1:]] - total[starts[:-1]])
                rest = np.flatnonzero(~inside)
                doc = np.searchsorted(starts, rest, "right") - 1
                word, state = _signed(tokens[1:][rest]), h[rest]
                order = np.lexsort((state, word, doc))
                doc, word, state = doc[order], word[order], state[order]
                new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1]) | (state[1:] != state[:-1]))) if len(doc) else np.zeros(0, np.int64)
                m = np.diff(np.append(new, len(doc)))
                each = pa.StructArray.from_arrays([pa.array(word[new]), pa.array(state[new].astype(np.int32)), pa.array(m.astype(np.int32))], ["word", "h", "m"])
                at = np.searchsorted(doc[new], np.arange(end - row + 1)).astype(np.int32)
                known = np.rint(sums[2]).astype(np.int64) if model.tokens else np.zeros(end - row, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, end - row) for i in (0, 1)), pa.array(np.diff(starts)), pa.array(known), pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(pa.array(at), each)],
                    ["at", "doc_id", "n_tokens", "n_known", "base", "score", "rest"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = written(rows.mapInArrow(frugal(run), f"at long, doc_id {kind}, n_tokens long, n_known long, base double, score double, rest {item}"), "lm-scored")
    size = np.log10(np.maximum(model.size, 1))
    cells = [(int(h), int(c), float(model.follows[h, c] - (size[c] if c < classes else 0.0))) for h in range(2 * classes) for c in range(classes + 1)]
    follows = F.broadcast(spark.createDataFrame(cells, "h int, c int, value double"))  # bounded by the classes
    rest = scored.select("at", F.explode("rest").alias("r")).select("at", F.col("r.word").alias("key"), "r.h", "r.m")
    met = rest.join(rare.where("kind = 0").select("key", "n", "c"), "key", "left")
    met = met.withColumn("c", F.coalesce("c", F.lit(classes))).join(follows, ["h", "c"])
    n = F.coalesce("n", F.lit(0))
    parts = met.select("at", F.when(n > 0, F.col("m")).otherwise(0).cast("long").alias("n_known"), (F.col("m") * F.log10((n + 0.5) / F.lit(whole))).alias("base"),
                       (F.col("m") * (F.col("value") + F.when(n > 0, F.log10(n.cast("double"))).otherwise(0.0))).alias("score"))
    parts = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n_known", "base", "score")])
    add = {c: F.col(f"s.{c}") + F.coalesce(F.col(f"p.{c}"), F.lit(0)) for c in ("n_known", "base", "score")}
    joined = scored.drop("rest").alias("s").join(parts.alias("p"), "at", "left")
    return joined.select("doc_id", held_out().alias("held_out"), "n_tokens", add["n_known"].alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
                         add["base"].alias("base_score"), add["score"].alias("score"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under a class model of those that aren't held out."""
    modest_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model, rare = fit(docs.where(~held_out()))
    return score(docs, model, rare)
