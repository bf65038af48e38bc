"""Quality rules (op4): distribution divergence from language references, in column expressions only.

Two histograms of each document are compared with its language's by Jensen-Shannon distance
(square root, base 2, between 0 and 1): character classes, and common words with one bin for all
others.  The references are sums over all documents of the language that pass the base rules.
Guards: a text under a minimum length is too small a sample of either histogram and isn't judged
by it, and above it the distance allowed falls as the sample grows.  Base rules: at least ``MIN_WORDS`` words, and at most 30 of 100 words in 8-word windows
that the text repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, table, written
from rollcall.llm.text import let, words
from rollcall.session import bounded_broadcast

# The commonest words of each language.
COMMON = {
    "en": "the of and to in a is that it for was on are as with be by at this from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au ou",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
OTHER = "other"  # documents of every other language, and of none
LISTED = {name: words_.split() for name, words_ in COMMON.items()}
LISTED[OTHER] = list(dict.fromkeys(w for listed in LISTED.values() for w in listed[:5]))
LETTERS = ".abcdefghijklmnopqrst"
MIN_WORDS, WINDOW, REPEATED_PERCENT = 20, 8, 30
MIN_CHARS, MIN_COMMON = 100, 40  # smaller samples aren't judged
# A sample's own distance from its source falls with the square root of its size: the most that is
# allowed at n words is (a + b / sqrt(n)).
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = (0.1, 1.5), (0.08, 2.0)


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text holds twice or more."""

    def covered(starts: Column) -> Column:
        gap = F.transform(starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
        return F.aggregate(gap, F.lit(0), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        same = F.filter(ordered, lambda e, k: (F.get(ordered, k - 1)["h"] == e["h"]) | (F.get(ordered, k + 1)["h"] == e["h"]))
        return let(F.sort_array(F.transform(same, lambda e: e["i"])), covered)

    def count(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ordered, twice))

    starts = F.sequence(F.lit(1), F.size(tokens) - (window - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, window)))
    return F.when(F.size(tokens) >= window, let(hashes, count)).otherwise(0).cast("long")


def common_words(tokens: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, and last all other words."""

    def code(listed: list[str]) -> Column:
        place = F.array(*(F.lit(w) for w in listed))
        letter = F.transform(tokens, lambda w: F.substr(F.lit(LETTERS), F.array_position(place, F.lower(F.rtrim(w, F.lit(".,;:!?")))).cast("int") + 1, F.lit(1)))
        return F.array_join(letter, "")

    whole = F.lit("")
    for name, listed in LISTED.items():
        whole = F.when(lang == name, code(listed)).otherwise(whole)
    letters = F.array(*(F.lit(c) for c in LETTERS[1:] + LETTERS[0]))
    return let(whole, lambda s: F.transform(letters, lambda c: (F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("long")))


def features(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``docs`` with ``_f``: base figures and both histograms."""
    whole = F.coalesce(F.col(text), F.lit(""))
    key = F.when(F.col(lang).isin(*COMMON), F.col(lang)).otherwise(OTHER)
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def figures(tokens: Column) -> Column:
        chars = F.length(F.array_join(tokens, "")).cast("long")
        return F.struct(
            key.alias("lang"),
            F.size(tokens).cast("long").alias("n_words"),
            chars.alias("word_chars"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated_words(tokens).alias("n_repeat_words"),
            common_words(tokens, key).alias("common"),
            F.array(*(F.regexp_count(whole, F.lit(p)).cast("long") for p in (r"[#*$%&|<>]", r"[.,;:!?]", r"[0-9]", r"\p{Lu}"))).alias("classes"),
        )

    # a generator, not a projection: no later step can fold the work into each of its uses
    return docs.select("*", F.explode(F.transform(F.array(words(text)), figures)).alias("_f"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null where one is empty."""

    def entropy(share: Column) -> Column:
        return F.aggregate(share, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log2(x)).otherwise(0.0))

    def shares(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
        return let(total, lambda t: F.when(t > 0, F.transform(values, lambda x: x / t)))

    def both(p: Column, q: Column) -> Column:
        middle = F.zip_with(p, q, lambda x, y: (x + y) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), entropy(middle) - (entropy(p) + entropy(q)) / 2))

    return let(shares(counts), lambda p: let(shares(reference), lambda q: F.when(p.isNotNull() & q.isNotNull(), both(p, q))))


def judge(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` and ``_j``: base figures, distances, ``base_failed`` and ``kept``; ``rows`` has ``_f`` and is read twice."""
    f = F.col("_f")
    failed = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > REPEATED_PERCENT * f["n_words"])
    rest = f["word_chars"] - F.aggregate(f["classes"], F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.select(*keep, "_f", failed.alias("_failed"), F.concat(f["classes"], F.array(F.greatest(rest, F.lit(0).cast("long")))).alias("_chars"))
    good = rows.where("not _failed").groupBy(F.col("_f.lang").alias("_lang"))
    sums = good.agg(F.array(*(F.sum(F.col("_chars")[i]) for i in range(5))).alias("_ref_chars"), F.array(*(F.sum(F.col("_f.common")[i]) for i in range(len(LETTERS)))).alias("_ref_words"))
    # at most one row per language of COMMON and one more
    rows = rows.join(F.broadcast(sums), F.col("_f.lang") == F.col("_lang"), "left")
    chars, common = distance(F.col("_chars"), F.col("_ref_chars")), distance(f["common"], F.col("_ref_words"))
    rows = rows.withColumns({"_dc": F.when(f["word_chars"] >= MIN_CHARS, chars), "_dw": F.when(f["n_words"] >= MIN_COMMON, common)})
    most = lambda limit: limit[0] + limit[1] / F.sqrt(F.greatest(f["n_words"], F.lit(1)))
    far = F.coalesce(F.col("_dc") > most(MAX_CHAR_DISTANCE), F.lit(False)) | F.coalesce(F.col("_dw") > most(MAX_WORD_DISTANCE), F.lit(False))
    figures = F.struct(
        f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"), f["classes"][0].alias("n_symbols"), f["n_dup_lines"].alias("n_dup_lines"),
        f["n_repeat_words"].alias("n_repeat_words"), F.col("_failed").alias("base_failed"), (~F.col("_failed") & ~far).alias("kept"),
        F.col("_dc").alias("char_distance"), F.col("_dw").alias("word_distance"),
    )
    return rows.select(*keep, figures.alias("_j"))


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs`` with its base figures, distances and verdict ``kept``.

    A null text counts as empty: no words, base_failed.  A null or unlisted language is compared
    with all such documents together.  Repeated rows are judged alike.  No rows give no rows.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = written(features(named, "text", "lang").select("doc_id", "_f"), "features")
    return judge(rows, ["doc_id"]).select("doc_id", "_j.*")


def passing(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that ``quality`` rejects; a row is named by its id, language and the hash of its text.

    The figures are worked out once, and only the names of rejected rows meet the texts again.
    Rows of one name are judged alike.  Columns of any name pass through.
    """
    name = F.struct(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id), F.lit(0)).alias("id"), F.coalesce(lang, F.lit("")).alias("lang"), F.xxhash64(text).alias("hash"))
    named = docs.select(name.alias("name"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = written(features(named, "text", "lang").select("name", "_f"), "features")
    rejected = bounded_broadcast(judge(rows, ["name"]).where("not _j.kept").select("name").distinct())
    forget(rows)
    packed = docs.select(F.struct("*").alias("row"), name.alias("name"))
    return packed.join(rejected, "name", "left_anti").select("row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")
