"""Brute force over small tables: n-gram join, substring dedup, quality, mixing, sharding, tokens."""

import zlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F

from rollcall.llm import mixing, ngram_join, pieces, quality, sharding, substring_dedup
from tests.llm.cases import SMALL, documents, empty, groups, removed, sha, sort, words


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["cases", "small"])
def docs(spark, request):
    return documents(spark) if request.param == "cases" else spark.read.parquet(f"{SMALL}/documents.parquet")


def test_ngram_join(spark, docs):
    got = ngram_join.ngram_groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sort(map(tuple, got)) == sort(groups(pairs(docs)))


def test_ngram_join_crowded_columns(spark, monkeypatch):
    """A group of near copies larger than the leaders of a column."""
    monkeypatch.setattr(ngram_join, "LEADERS", 3)
    rows = []
    base = [f"b{i}" for i in range(120)]
    for k in range(30):
        text = list(base)
        for j in range(k % 5):
            text[(7 * k + 31 * j) % 120] = f"x{k}_{j}"
        rows.append((k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.ngram_groups(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sort(map(tuple, got)) == sort(groups(rows))


@pytest.mark.parametrize("percent", [51, 67, 80, 90, 100])
def test_ngram_join_short_texts(spark, percent):
    """Sets of a few n-grams, each with one that has one n-gram more."""
    rows = []
    for size in range(1, 14):
        text = [f"s{size}_{j}" for j in range(size + 2)]
        rows += [(10 * size, " ".join(text)), (10 * size + 1, " ".join([*text, "more"])), (10 * size + 2, " ".join(text).upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.ngram_groups(df, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sort(map(tuple, got)) == sort(groups(rows, percent))


def test_one_of_each(spark, docs):
    rows = pairs(docs)
    kept = pairs(ngram_join.one_of_each(docs))
    named = groups(rows)
    empty_ = sum(n == 0 for _, n, _ in named)
    # null ids stand apart here: their component's smallest id is another row's, or none
    wanted = {c for _, n, c in named if n and c is not None}
    assert {i for i, t in kept if words(t) and i is not None} >= wanted - {None}
    assert len(kept) == empty_ + len(wanted) + sum(1 for i, n, c in named if n and c is None)


def test_one_of_each_by_other_ngrams(spark):
    """Two changed words of a hundred: 0.81 of the 5-word n-grams are shared, too few of the 3-word ones for 0.9."""
    base = [f"b{i}" for i in range(100)]
    near = [{30: "x", 70: "y"}.get(i, w) for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, "a b c d e f g h"), (4, "a b c d e f g h i"), (5, "a b c d"), (6, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sort(pairs(ngram_join.one_of_each(df))) == sort(rows)
    assert sorted(i for i, _ in pairs(ngram_join.one_of_each(df, n=5, percent=80))) == [1, 3, 5, 6]


def test_substring_dedup(spark, docs):
    rows = pairs(docs)
    got = substring_dedup.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    want = [(i, len(words(t)), len(words(t)) - len(k), sha(k)) for (i, t), k in zip(rows, removed([t for _, t in rows]), strict=True)]
    assert sort(map(tuple, got)) == sort(want)


@pytest.mark.parametrize("window, base", [(5, 5), (9, 3), (12, 4)])
def test_substring_dedup_levels(spark, window, base):
    texts = ["a b c d e f g h i j k l m", "x a b c d e f g h i j k l y", "a b a b a b a b a b a b a b", "q r s t u v w x y z", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_dedup.dedup_substrings(df, window=window, base=base).select("doc_id", "kept").collect()
    assert sort(map(tuple, got)) == sort((i, " ".join(k)) for i, k in enumerate(removed(texts, window)))


def base_figures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), failed


def test_quality_base(spark, docs):
    got = quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sort(map(tuple, got.collect())) == sort((i, *base_figures(t)) for i, t in pairs(docs))


def test_quality_verdict(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs).join(labels, "doc_id").where("not base_failed").collect()
    clean = [r for r in rows if r["quality"] == 1]
    junk = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.995 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.95 * len(junk)


def test_distance(spark):
    row = spark.range(1).select(
        quality.distance(F.array(*map(F.lit, (1, 1))).cast("array<long>"), F.array(*map(F.lit, (5, 5))).cast("array<long>")).alias("same"),
        quality.distance(F.array(*map(F.lit, (3, 0))).cast("array<long>"), F.array(*map(F.lit, (0, 4))).cast("array<long>")).alias("apart"),
        quality.distance(F.array(*map(F.lit, (0, 0))).cast("array<long>"), F.array(*map(F.lit, (0, 4))).cast("array<long>")).alias("none"),
    ).first()
    assert row["same"] == pytest.approx(0) and row["apart"] == pytest.approx(1) and row["none"] is None


def test_mixing(spark, docs):
    got = mixing.mix(docs)[0]
    _, sources = mixing.mix(docs)
    info = {r["name"]: (r["source_size"], r["target"]) for r in sources.collect()}
    sizes, most, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += len(words(r["text"]))
        most[r["source"]] = max(most[r["source"]], len(words(r["text"])))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    # targets stop at 2 times the size; the excess goes to the others by weight
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        if not (above := {s for s in share if share[s] > 2 * sizes[s]}):
            break
        capped |= above
    for s in names:
        assert info[s] == (sizes[s], pytest.approx(2.0 * sizes[s] if s in capped else share[s]))
    rows = got.select("source", "text", "_size", "_passes").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["_size"] == len(words(r["text"])) and 0 <= r["_passes"] <= 2
        taken[r["source"]] += r["_size"] * r["_passes"]
    for s in names:
        assert abs(taken[s] - info[s][1]) <= 2 * most[s]
    again = mixing.mix(docs)[0].select("source", "text", "_size", "_passes").collect()
    assert sort(map(tuple, rows)) == sort(map(tuple, again))


def test_flow_shares_overlaps():
    # source 0 only has pattern (0, 1); source 1 can leave it and use its own
    assert mixing.flow([(0, 1), (1,)], [10, 10], [10, 10], 2) == [10, 10]
    # first copies of all patterns before any second one
    assert mixing.flow([(0,), (0, 1)], [10, 10], [15, 5], 2) == [10, 10]
    assert mixing.flow([(0,)], [10], [17], 2) == [17]
    assert mixing.flow([(0,)], [10], [30], 2) == [20]


def test_sharding(spark, docs):
    got = sharding.shard_documents(docs, shards=4, slots=512).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32(t.encode()) if t is not None else None) for i, t in pairs(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    loads, places = defaultdict(int), defaultdict(list)
    for r in got:
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert set(loads) <= set(range(4))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(loads.values()) - min(loads.get(s, 0) for s in range(4)) <= max(r["size"] for r in got)


def test_sharding_moves_few_slots(spark):
    sizes = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % 7 + 1).alias("bytes"), F.lit(1).alias("rows"))
    log = sharding.first_map(spark, 64, 4)
    log = log.unionByName(sharding.rebalance(log, sizes, 4, 1))
    grown = sharding.rebalance(log, sizes, 5, 2)
    moved = grown.join(sizes, grown.slot == sizes.virtual_slot).agg(F.sum("bytes"), F.countDistinct("shard")).first()
    total = sizes.agg(F.sum("bytes")).first()[0]
    # the new shard's fifth, and little else
    assert total / 5 - 7 <= moved[0] <= total / 3
    log = log.unionByName(grown)
    loads = sharding.current(log).join(sizes, F.col("slot") == F.col("virtual_slot")).groupBy("shard").agg(F.sum("bytes").alias("b")).collect()
    assert len(loads) == 5 and max(r["b"] for r in loads) - min(r["b"] for r in loads) <= 7


def test_tokens_equal_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = pieces.encode_documents(docs)
    want = [(i, len(ids := library.encode(t or "")), ids, True) for i, t in pairs(docs)]
    assert sort(map(tuple, got.collect())) == sort(want)
    texts = pieces.decode_documents(got).collect()
    assert sort(map(tuple, texts)) == sort((i, (t or "").replace("▁", " ")) for i, t in pairs(docs))


def test_no_rows(spark):
    none = empty(spark)
    for out in (
        ngram_join.ngram_groups(none), ngram_join.one_of_each(none), substring_dedup.dedup_substrings(none), quality.quality(none),
        mixing.mix(none)[0], sharding.shard_documents(none), pieces.encode_documents(none),
    ):
        assert out.count() == 0
