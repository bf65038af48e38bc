"""Spelling variant grouping (op12): words one edit apart, by an index of variable-length grams.

* **Dictionary.**  Grams of ``QMIN`` to ``QMAX`` code points are counted over all words (with a mark
  at either end).  A gram whose prefix, one shorter, stands in more than ``FREQUENT`` words' places is
  in the dictionary, so common grams are told apart by longer ones.  It holds at most ``DICTIONARY``
  grams: where there are more, the threshold rises.  Any dictionary gives the same result.
* **Decomposition.**  At each place a word takes the longest dictionary gram (else the ``QMIN`` code
  points there), unless a gram taken before covers it.
* **Bound.**  For each word and each place of an edit it is counted how many of its grams the edit
  can affect: those that it changes, and those beside it that a longer gram reaching over the edit
  may replace.  The most is the word's affected-gram bound; all other grams stand in every word one
  edit away, at the same place or one beside.
* **Merging.**  So two near words share a gram among the bound + 1 rarest of each, at places and
  lengths that fit: only these lists are merged.  A pair is dropped where either word has more grams
  that the other lacks than its bound allows (told by a bit a gram, of 64: a bit that is missing is a
  gram that is missing).  The rest is verified by edit distance.
* Words all of whose grams one edit can affect list all of them; pairs of two such words, which
  need not share any, are found by the texts they leave with one code point taken out.

A key (gram, place, length) holds distinct words only, so a word that fills a third of all texts is
one row.  A null text has no words and a null id counts as the empty string.  Rows with equal ids and
texts count each; other columns are not looked at; an empty table has no words.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, table, written

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
EVERY = 31  # one run of so many, by its hash, loses a code point
QMIN, QMAX, FREQUENT, DICTIONARY = 2, 4, 1000, 1 << 16
FIRST, LAST = "\x02", "\x03"  # marks at a word's ends
HOPS = 5  # a form is ten times as frequent as its word, so no chain of 64-bit counts is longer than 2 ** HOPS


def counted_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(word, n)`` of the lower-cased runs of letters, after damage, that are long and frequent enough."""
    # shorter runs can't become words: damage only shortens
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{MIN_LENGTH},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run"))
    words = each.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT, size: int = DICTIONARY) -> tuple[set[str], dict[str, int]]:
    """The dictionary's grams, and the number of each gram that a word may be given, rarest first (at most ``size`` and the pairs of letters)."""
    marked = words.select(F.concat(F.lit(FIRST), "word", F.lit(LAST)).alias("w"))

    def of_length(q: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("w") - q + 1), lambda i: F.substring("w", i, F.lit(q)))

    grams = F.flatten(F.array(*[of_length(q) for q in range(QMIN, QMAX + 1)]))
    counts = marked.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    counts = written(counts, "gram-counts")
    prefix = counts.select(F.col("gram").alias("p"), F.col("n").alias("over")).where(F.length("p") < QMAX)
    longer = counts.where(F.length("gram") > QMIN).withColumn("p", F.expr("left(gram, length(gram) - 1)")).join(prefix, "p")
    longer = longer.where(F.col("over") > frequent).select("gram", "n", "over")
    kept = longer.orderBy(F.desc("over"), "gram").limit(size + 1).collect()  # bounded by ``size``
    if len(kept) > size:  # the threshold rises to what the first gram left out extends
        kept = [r for r in kept if r["over"] > kept[size]["over"]]
    pairs = counts.where(F.length("gram") == QMIN).collect()  # at most the square of the alphabet
    order = sorted([(r["n"], r["gram"]) for r in kept + pairs])
    forget(counts)
    return {r["gram"] for r in kept}, {gram: i for i, (_, gram) in enumerate(order)}


class Grams:
    """Decomposition of words by a dictionary, and their affected-gram bounds."""

    def __init__(self, grams: set[str]):
        self.grams = grams
        self.heads = {g[:k] for g in grams for k in range(1, len(g))}
        self.tails = {g[k:] for g in grams for k in range(1, len(g))}

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """``(place, length)`` of the grams of the marked word ``s``."""
        out, done, grams, n = [], 0, self.grams, len(s)
        for p in range(n - QMIN + 1):
            q = min(QMAX, n - p)
            while q > QMIN and s[p : p + q] not in grams:
                q -= 1
            if p + q > done:
                out.append((p, q))
                done = p + q
        return out

    def bound(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of ``s`` that one inserted, deleted or replaced code point can affect."""
        most, n, first = 0, len(s), 0
        heads, tails = self.heads, self.tails
        for i in range(1, n):  # an edit of code point i (after = i + 1), or an insertion before it (after = i)
            left = i
            for k in range(max(0, i - QMAX + 1), i):
                if s[k:i] in heads:
                    left = k
                    break
            while first < len(grams) and grams[first][0] + QMAX < i:
                first += 1
            for after in (i, i + 1) if i < n - 1 else (i,):
                right = after
                for k in range(min(n, after + QMAX - 1), after, -1):
                    if s[after:k] in tails:
                        right = k
                        break
                hit = 0
                for p, q in grams[first:]:
                    if p > right:
                        break
                    if p + q <= i:
                        hit += p >= left
                    elif p >= after:
                        hit += p + q <= right
                    else:
                        hit += 1
                most = max(most, hit)
        return most


def listed(words: DataFrame, dictionary: set[str], numbers: dict[str, int]) -> DataFrame:
    """Per word the lists to merge: ``(word, n, length, affected, bits, weak, grams)``.

    ``affected`` is its bound, ``grams`` are (gram, place) of the bound + 1 rarest of its grams, ``bits`` stand for all of
    them, and a ``weak`` word has no gram that every near word has too.
    """
    shared = words.sparkSession.sparkContext.broadcast((dictionary, numbers))

    def run(batches):
        dictionary, numbers = shared.value
        index = Grams(dictionary)
        for batch in batches:
            bound, weak, bits, offsets, flat = [], [], [], [0], []
            for w in batch.column(0).to_pylist():
                s = FIRST + w + LAST
                grams = index.decompose(s)
                affected = index.bound(s, grams)
                named = sorted((numbers[s[p : p + q]], p) for p, q in grams)
                flat += named[: affected + 1]
                bits.append(functools.reduce(int.__or__, (1 << (g & 63) for g, _ in named)))
                bound.append(affected)
                weak.append(affected >= len(grams))
                offsets.append(len(flat))
            items = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.int32()) for k in range(2)], ["gram", "place"])
            columns = [pa.array(bound, pa.int32()), pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(weak, pa.bool_()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["word", "n", "affected", "bits", "weak", "grams"])

    rows = words.select("word", "n").mapInArrow(run, "word string, n long, affected int, bits long, weak boolean, grams array<struct<gram: int, place: int>>")
    return rows.withColumn("length", F.length("word"))


def _near(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def near_words(words: DataFrame, frequent: int = FREQUENT, size: int = DICTIONARY) -> DataFrame:
    """``(a, na, b, nb)``: every pair of words exactly one edit apart, once."""
    lists = written(listed(words, *gram_dictionary(words, frequent, size)), "gram-lists")
    own = ("word", "n", "affected", "bits")
    each = lists.select(*own, "length", F.explode("grams").alias("g")).select(*own, "length", "g.*")
    left = each.select("gram", "place", "length", *[F.col(c).alias(f"a_{c}") for c in own])
    # the longer word b lists a gram where the shorter one, or one as long, would have it
    fits = F.array(F.struct("place", "length"), F.struct("place", (F.col("length") - 1).alias("length")),
                   F.struct((F.col("place") - 1).alias("place"), (F.col("length") - 1).alias("length")))
    right = each.select("gram", F.explode(fits).alias("f"), F.col("length").alias("b_length"), *[F.col(c).alias(f"b_{c}") for c in own])
    right = right.select("gram", "f.place", "f.length", *[c for c in right.columns if c.startswith("b_")])
    met = left.join(right, ["gram", "place", "length"])
    met = met.where((F.col("b_length") > F.col("length")) | (F.col("a_word") < F.col("b_word")))
    lacks = lambda x, y: F.bit_count(F.col(f"{x}_bits").bitwiseAND(F.bitwise_not(F.col(f"{y}_bits")))) <= F.col(f"{x}_affected")
    met = met.where(lacks("a", "b") & lacks("b", "a") & _near(F.col("a_word"), F.col("b_word")))
    pairs = met.select(F.col("a_word").alias("a"), F.col("a_n").alias("na"), F.col("b_word").alias("b"), F.col("b_n").alias("nb"))

    weak = lists.where("weak").select("word", "n", "length")
    cut = F.transform(F.sequence(F.lit(1), F.col("length")), lambda i: F.struct(
        F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.col("length"))).alias("rest"), i.alias("at")))
    rests = weak.select("word", "n", F.explode(cut).alias("c")).select("word", "n", "c.*")
    x, y = (rests.select("rest", "at", F.col("word").alias(w), F.col("n").alias(f"n{w}")) for w in "ab")
    replaced = x.join(y, ["rest", "at"]).where("a < b").select("a", "na", "b", "nb")
    longer = weak.select(F.col("word").alias("a"), F.col("n").alias("na")).join(y, F.col("a") == F.col("rest")).select("a", "na", "b", "nb")
    return pairs.unionByName(replaced).unionByName(longer).distinct()


def spelling_forms(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", frequent: int = FREQUENT, size: int = DICTIONARY) -> DataFrame:
    """Per word its form (the most frequent near word, if that is much more frequent) and its root (the last form)."""
    words = written(counted_words(docs, text, doc_id), "spelling-words")
    pairs = near_words(words, frequent, size)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("na").alias("own"), (-F.col("nb")).alias("less"), F.col("b").alias("other")),
                   F.struct(F.col("b").alias("word"), F.col("nb").alias("own"), (-F.col("na")).alias("less"), F.col("a").alias("other")))
    near = pairs.select(F.explode(both).alias("p")).select("p.*").groupBy("word", "own").agg(
        F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
    formed = -F.col("best.less") >= RATIO * F.col("own")
    near = written(near.select("word", "n_near", F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-near")
    root = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(HOPS):
        root = written(root, "spelling-root")
        further = root.select(F.col("word").alias("root"), F.col("root").alias("further"))
        root = root.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    out = words.join(near, "word", "left").join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, each with its form."""
    return spelling_forms(table(spark, sf_dir, "documents"))
