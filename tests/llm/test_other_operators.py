"""Quotation linking, WARC, vectors, toxicity, components; queries against SQL; the pipeline against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import mixing, pieces, quality, quotes, toxicity, vector_join, warc
from rollcall.llm.components import components
from rollcall.llm.oracle import ORACLE
from rollcall.llm.queries import QUERIES
from rollcall.llm.textvec import Windows, Words, leftmost_minima
from tests.compare import compare, duck
from tests.llm.cases import SMALL, documents, groups, removed, sort, words


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(spark, QUERIES[name], ORACLE[name], SMALL, duck(SMALL))
    assert res["match"] is True, res


def test_words_and_windows_are_told_apart():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n\r\x0b\x0cé") for _ in range(rng.randrange(40))) for _ in range(200)]
    column = pa.array(texts)
    found = Words(*__import__("rollcall.llm.textvec", fromlist=["column_bytes"]).column_bytes(column))
    want = [words(t) for t in texts]
    assert found.counts().tolist() == [len(w) for w in want]
    names = defaultdict(set)
    for h, w in zip(found.hashes().tolist(), (x for w in want for x in w), strict=True):
        names[h].add(w)
    assert all(len(v) == 1 for v in names.values()) and len(names) == len({x for w in want for x in w})
    windows = Windows(found.hashes())
    inside = windows.valid(found.first, 3)
    got = Counter(windows.hashes(3)[inside].tolist())
    assert sorted(got.values()) == sorted(Counter(tuple(w[i : i + 3]) for w in want for i in range(len(w) - 2)).values())


@pytest.mark.parametrize("width", [1, 2, 3, 7, 8, 13])
def test_leftmost_minima(width):
    values = np.random.default_rng(width).integers(0, 6, 50)
    assert leftmost_minima(values, width).tolist() == [i + int(values[i : i + width].argmin()) for i in range(51 - width)]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), (2000, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if b is not None and a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# quotes


def linked(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, root long, k string")
    return {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(df).collect()}


def test_quotes_link_replies(spark):
    rows = [
        (1, 0, "user", "Hello there\nsecond line"),
        (1, 1, "assistant", "> hello   THERE\n> second line\n\nAn answer"),
        (1, 2, "user", "before\n>> hello there\n>> second line\n> an answer\nafter"),
        (1, 3, "user", ">Hello there\n>second line\nbranch"),  # a second reply to the first
        (1, 4, "user", "> never said\nnew thread"),
        (1, 5, None, None),
        (1, 6, "user", ""),
        (1, 7, "user", "> \n>\nonly empty quotes"),
        (2, 0, "user", "> Hello there\n> second line\nother conversation"),
        (None, 0, "user", "x"), (None, 1, "user", "> x\ny"),
        (3, 0, "user", "first part\n\nsecond part"), (3, 1, "user", "> second part\nre"), (3, 1, "user", "> second part\nre"),
        (4, 0, "user", "ok"), (4, 1, "user", "> ok\nok"), (4, 2, "user", ">> ok\n> ok\nyes"), (4, 3, "user", "> ok\nlate"),
        (5, 1, "user", "> later\nearly"), (5, 2, "user", "later"),
    ]
    got = linked(spark, [(*r, 9, "clash") for r in rows])
    parent = {k: r["parent_turn"] for k, r in got.items()}
    assert [parent[1, t] for t in range(8)] == [None, 0, 1, 0, None, None, None, None]
    assert (got[1, 2]["root_turn"], got[1, 2]["reply_depth"], got[1, 2]["content"]) == (0, 2, "before\nafter")
    assert got[1, 1]["content"] == "\nAn answer"
    assert parent[2, 0] is None and parent[None, 1] is None
    assert parent[3, 1] == 0 and len(got) == len(rows) - 1
    # equal texts: the quoted text's own quote tells which was meant, else the earliest
    assert (parent[4, 1], parent[4, 2], parent[4, 3]) == (0, 1, 0)
    assert parent[5, 1] is None
    assert linked(spark, []) == {}


def mail(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return [(r["conv_id"], r["turn"], r["parent_turn"], r["root_turn"], r["reply_depth"]) for r in quotes.link_quotes(quotes.mailed(df)).collect()]


def test_repeated_exchanges_link_to_the_turn_before(spark):
    """Of equal originals the latest before the reply; the same text very often lies in several ranges."""
    said = ["AB" * 3, "AAAA", "ABCAB", "AABAAB", "AB" * 60]
    rows = [(c, t, "user", x) for c, texts in enumerate(said) for t, x in enumerate(texts)]
    assert sort(mail(spark, rows)) == sort((c, t, t - 1 if t else None, 0, t) for c, t, _, _ in rows)
    # a quote without the original's own quote, and an original that comes only later
    late = [(1, 0, "a", "> q\nsame", 0, ""), (1, 3, "a", "> r\nsame", 0, ""), (1, 3, "a", "> same\nx", 0, ""), (1, 4, "a", "> same\ny", 0, ""), (1, 5, "a", ">> q\n> same\nz", 0, "")]
    got = {(r["turn"], r["content"]): r["parent_turn"] for r in quotes.link_quotes(spark.createDataFrame(late, "conv_id long, turn long, role string, text string, root long, k string")).collect()}
    assert got == {(0, "same"): None, (3, "same"): None, (3, "x"): 0, (4, "y"): 3, (5, "z"): 0}


def test_mail_has_one_message_per_row_whatever_repeats(spark):
    rows = [(1, t, "user", f"text {t}") for t in range(4)] * 5 + [(2, 0, "user", "one"), (2, 0, "user", "other"), (2, 1, "user", "re"), (2, 2, "user", "re re"), (2, 1, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert quotes.mailed(df).count() == len(set(rows))
    assert sort(mail(spark, rows)) == sort([*((1, t, t - 1 if t else None, 0, t) for t in range(4)), (2, 0, None, 0, 0), (2, 0, None, 0, 0), (2, 1, 0, 0, 1), (2, 1, 0, 0, 1), (2, 2, 1, 0, 2)])


def test_the_shallowest_quote_that_is_found_is_the_parent(spark):
    rows = [
        (1, 0, "a", "start"), (1, 1, "b", ">> start\nonly a deeper quote"), (1, 2, "c", ">> start\n> this one is missing\nre"),
        (1, 3, "d", ">>> start\n>> lost\n> only a deeper quote\nre re"), (1, 4, "e", ">>> re\n>> gone\n> lost\ndeep"), (1, 5, "f", "> lost\n>> gone\nnothing there"),
    ]
    got = linked(spark, [(*r, 9, "clash") for r in rows])
    assert {t: r["parent_turn"] for (_, t), r in got.items()} == {0: None, 1: 0, 2: 0, 3: 1, 4: 2, 5: None}


# WARC


def test_warc_round_trip_in_ranges(spark):
    rows = [(1, "http://a/é", "<p>é</p>"), (2, "http://b\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "z" * 300_000), (6, "u", "".join(map(chr, range(32, 300))) * 50),
            (None, "u", "<p>é</p>"), (None, "n", "null only"), (None, "n", "null only"), (2, "again", "<p>é</p>"), (7, "u", "\x1f\x8b\x08 WARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, digest int, first string").repartition(2)
    files = warc.write(df)
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        head = first.get(html or "")
        revisit = head is not None and page != head
        want.append((page, None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if revisit else "response", head if revisit else None, None if revisit else data))
    for step in (None, 100, 777, 1 << 20):
        got = [(*r[:6], None if r[6] is None else bytes(r[6])) for r in warc.read(files, range_bytes=step).collect()]
        assert sort(got) == sort(want)
    small = warc.read(warc.write(df, min_bytes=10), payload=False).where("record_type = 'revisit'").collect()
    assert small == []
    assert warc.read(warc.write(df.where("false"))).count() == 0


def test_warc_damage_is_an_error(tmp_path):
    good = warc.member(1, "u", b"a" * 100, None) + warc.member(2, "u", b"b" * 100, None)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(good)
    assert [warc.parse(r)["page_id"] for r in warc.Archive(str(path)).records(0, len(good))] == [1, 2]
    path.write_bytes(good[:-20])
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.Archive(str(path)).records(0, len(good)))


# vectors


def brute_vectors(rows, cosine=0.9):
    ok, units = [], []
    for _, v in rows:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(good)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if good else None)
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(len(rows))]
    out = []
    for i, (id_, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = min(ids) if ok[i] and ids else id_
        out.append((id_, len(near[i]), comp, id_ == comp))
    return out


def vectors(seed, count, dim, noise):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((count // 6, dim))
    return [(i, [float(np.float32(x)) for x in centres[i % len(centres)] + noise * r.standard_normal(dim)]) for i in range(count)]


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_vectors(spark, kind):
    rows = vectors(1, 300, 32, 0.15)
    same = rows[5][1]
    rows += [(900, same), (901, same), (901, same), (None, same), (902, [2 * x for x in same]), (903, None), (904, []), (905, [0.0] * 32), (906, [1.0, None] * 16),
             (907, [float("nan")] * 32), (908, [float("inf")] + [0.0] * 31), (909, [1.0]), (910, [2.0]), (911, [-1.0]), (912, [1.0, 0.0]), (None, None)]
    if kind == "array<double>":
        rows += [(920, [1e300] * 32), (921, [1e-300] * 32)]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], f"vec_id long, embedding {kind}, node int, links string")
    got = [tuple(r) for r in vector_join.near_vectors(df).collect()]
    assert sort(got) == sort(brute_vectors(rows))
    assert vector_join.near_vectors(df.where("false")).count() == 0


def test_crowded_filters_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK", 16)
    rows = vectors(2, 240, 24, 0.12)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: tuple(r) for r in vector_join.near_vectors(df).collect()}
    want = {r[0]: r for r in brute_vectors(rows)}
    found, all_ = (sum(r[1] for r in x.values()) for x in (got, want))
    assert found >= 0.99 * all_ and all(got[k][1] <= want[k][1] for k in want)


def test_vector_recall(spark):
    r = np.random.default_rng(4)
    a = r.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.standard_normal(a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.905 * a + np.sqrt(1 - 0.905**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    out = vector_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).where("n_links > 0").count()
    assert out >= 0.98 * 3000


@pytest.mark.parametrize(("dim", "power"), [(64, 4), (64, 5), (64, 6), (64, 7), (64, 8), (64, 9), (256, 5), (256, 7)])
def test_recall_holds_at_any_size(dim, power):
    code = vector_join.Code(dim, *vector_join.designed(dim, 10**power))
    assert vector_join.recall(code, *vector_join.pairs_at(0.9, 400, dim, 99)) >= 0.95


def test_decoding_finds_every_direction_above_the_height():
    r = np.random.default_rng(8)
    code = vector_join.Code(20, 40, 0.35)
    units = vector_join.unit(r.standard_normal((50, 20)))
    for each, found in zip(units, code.decode(units), strict=True):
        turned = each @ code.rotation
        sums = ((turned[:10] @ code.blocks[0].T)[:, None] + (turned[10:] @ code.blocks[1].T)[None, :]).ravel()
        assert found.tolist() == np.sort(np.argsort(-sums)[: max(vector_join.LEAST, (sums >= 0.35).sum())]).tolist()


def test_many_near_copies(spark):
    r = np.random.default_rng(12)
    rows = r.standard_normal(32) + 0.02 * r.standard_normal((5000, 32))
    rows = np.concatenate([rows, r.standard_normal((300, 32))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    got = df.transform(vector_join.near_vectors).where("vec_id < 5000").agg(F.min("n_links"), F.max("n_links"), F.countDistinct("component_id")).first()
    assert tuple(got) == (4999, 4999, 1)


# toxicity


def test_machine_learns_a_pair_that_neither_term_shows(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        text = [rng.choice("lorem ipsum dolor sit amet consectetur".split()) for _ in range(12)] + ["Insult!"] * insult + ["(group)"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(insult and group)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(docs.where("doc_id < 600"), marks, "doc_id", "text", "toxic")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine, "doc_id", "text").collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, y in labels[600:])
    pair = machine.active[[n for _, _, _, n in toxicity.terms(pa.array(["insult group"]))][0][:2]]
    assert machine.factors[pair[0]] @ machine.factors[pair[1]] > 0


def test_machine_learns_a_rare_term_that_counts_only_beside_another(spark):
    """A group stands in few rows, as often without an insult as with one: it says nothing alone."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(6000):
        insult = rng.random() < 0.1
        group = rng.random() < (0.2 if insult else 0.06)
        text = [rng.choice("lorem ipsum dolor sit amet consectetur".split()) for _ in range(12)] + ["Insult!"] * insult + ["(group)"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(rng.random() < (0.95 if insult and group else 0.2 if insult else 0.1))))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(docs, marks, "doc_id", "text", "toxic")
    both, insult, group = (toxicity.score(spark.createDataFrame([(1, t)], "doc_id long, text string"), machine, "doc_id", "text").first()["score"] for t in ("insult group", "insult", "group"))
    assert both > 0.6 and insult < 0.4 and group < 0.4


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "if(id % 2 = 0, 'foul word', 'fair word') AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2 = 0) AS toxic")
    many = spark.range(100_000).selectExpr("0L AS doc_id", "'foul word' AS text")
    once = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    again = toxicity.fit(docs.unionByName(many), labels.unionByName(many.selectExpr("doc_id", "1 AS toxic")), "doc_id", "text", "toxic")
    assert (once.active == again.active).all() and (once.linear == again.linear).all() and once.bias == again.bias


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(8)
    active = np.full(1 << toxicity.BITS, -1, np.int64)
    active[:5] = np.arange(5)
    m = toxicity.Machine(active, -0.3, rng.standard_normal(5), rng.standard_normal((5, 3)))
    for chosen in ([], [0], [1, 3], [0, 1, 2, 3, 4]):
        raw = m.bias + m.linear[chosen].sum() + sum(m.factors[i] @ m.factors[j] for i in chosen for j in chosen if i < j)
        got = m.scores(1, np.zeros(2 * len(chosen) + 1, np.int64), np.array(chosen + chosen + [99]))
        assert got[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op9_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    toxic = [r for r in got if r["toxic"] == 1]
    clean = [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)


def test_toxicity_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (None, 0), (4, None), (19, 0), (999, 1)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    got = toxicity.score(docs, machine, "doc_id", "text").collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.fit(docs.where("false"), labels, "doc_id", "text", "toxic")
    assert toxicity.score(docs.where("false"), none, "doc_id", "text").count() == 0


# SentencePiece


def unigram_model(scored):
    def field(n, kind, body):
        return bytes([n << 3 | kind]) + body

    def block(n, body):
        size, out = len(body), b""
        while size >= 128:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return bytes([n << 3 | 2]) + out + bytes([size]) + body

    import struct

    data = block(1, block(1, b"<unk>") + field(2, 5, struct.pack("<f", 0)) + field(3, 0, b"\x02"))
    for piece, score in scored:
        data += block(1, block(1, piece.encode()) + field(2, 5, struct.pack("<f", score)))
    return data + block(2, field(3, 0, b"\x01")) + block(3, block(1, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))


def test_viterbi_finds_the_best_cut():
    rng = random.Random(9)
    alphabet = "abcé"
    scored = {c: -5.0 - rng.random() for c in alphabet} | {"▁": -4.0}
    for _ in range(40):
        scored["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 5)))] = -3.0 - 4 * rng.random()
        scored["▁" + "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 4)))] = -3.0 - 4 * rng.random()
    model = pieces.Model(unigram_model(list(scored.items())))
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(6))) for _ in range(60)] + ["", None, "a" * 200]
    got = [x for _, _, ids, offsets, _, _ in pieces.Encoder(model).encode(pa.array(texts)) for x in np.split(ids, offsets[1:-1])]

    def best(text):
        value = [0.0] + [-1e9] * len(text)
        for i in range(1, len(text) + 1):
            value[i] = max(value[j] + scored[text[j:i]] for j in range(max(0, i - 8), i) if text[j:i] in scored)
        return value[-1]

    for text, ids in zip(texts, got, strict=True):
        whole = ("▁" + text.replace(" ", "▁")) if text else ""
        assert "".join(model.pieces[i] for i in ids) == whole
        assert sum(scored[model.pieces[i]] for i in ids) == pytest.approx(best(whole), rel=1e-5, abs=1e-4)


def test_long_words_and_odd_characters_equal_the_library(spark):
    rng = random.Random(10)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["the" * 400, "ab" * 3000, "".join(rng.choice("etaoinshr") for _ in range(3000)), "漢字かな交じり文" * 60, "\U0001f600" * 50, "a\nb\n\n\nc\t\td  e   f", "   ", " lead", "trail ",
             "".join(rng.choice("ab cé漢\n▁0123456789") for _ in range(2000)), "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["ids"], r["round_trip"]) for r in pieces.encode_documents(df).collect()}
    assert got == {i: (library.encode(t), True) for i, t in enumerate(texts)}


def tokens(model, texts):
    return [x.tolist() for _, _, ids, offsets, _, _ in pieces.Encoder(model).encode(pa.array(texts, pa.large_string())) for x in np.split(ids, offsets[1:-1])]


@pytest.mark.parametrize(("longest", "step"), [(64, 1 << 12), (3, 7)])
def test_compatible_pieces_are_the_encoding(monkeypatch, longest, step):
    """Position by position with compatible pairs: the library's ids, and those of merges; long segments in steps too."""
    monkeypatch.setattr(pieces, "LONGEST", longest)
    monkeypatch.setattr(pieces, "STEP", step)
    rng = random.Random(11)
    with open(pieces.MODEL, "rb") as f:
        model = pieces.Model(f.read())
    assert model.parts is not None
    letters = ["aabbcde  nrstioéü屋ทา★xX#=-_\n\t\U0001f600", "aeinrst", "ab", "= -_#"]
    texts = ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["".join(rng.choice(some) for _ in range(rng.randrange(400))) for some in letters for _ in range(20)] + ["x" * 999, " " * 300 + "a" * 200, ""]
    want = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL).encode(texts)
    assert tokens(model, texts) == want
    model.parts = None
    assert tokens(model, texts) == want


def test_models_that_merge_by_falling_ranks_have_no_parts():
    """abc is formed by a merge (b with c) that ranks after it: its encoding goes by merges."""
    scored = [("▁", -9.0), ("a", -9.0), ("b", -9.0), ("c", -9.0), ("abc", -1.0), ("bc", -2.0)]
    data = unigram_model(scored)
    rising = unigram_model([(p, {"abc": -2.0, "bc": -1.0}.get(p, s)) for p, s in scored])
    assert data.count(b"\x12\x02\x18\x01") == rising.count(b"\x12\x02\x18\x01") == 1
    models = [pieces.Model(d.replace(b"\x12\x02\x18\x01", b"\x12\x02\x18\x02")) for d in (data, rising)]  # BPE in place of unigram
    assert models[0].parts is None and models[1].parts is not None
    for model in models:
        assert [[model.pieces[i] for i in ids] for ids in tokens(model, ["abcab", "cbcabc"])] == [["▁", "abc", "a", "b"], ["▁", "c", "bc", "abc"]]


# the pipeline


def brute_pipeline(spark, sf):
    """Every stage by brute force; quality's distances and the mix's seeded order come from the operators, whose own tests hold them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality(docs).where("kept").select("doc_id").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect() if r["doc_id"] in kept]
    named = groups([(i, t) for i, t, _, _ in rows], percent=80, n=5)
    rows = [r for r, (i, _, c) in zip(rows, named, strict=True) if i == c]
    rows = [(i, " ".join(k), lang, source) for (i, _, lang, source), k in zip(rows, removed([t for _, t, _, _ in rows]), strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    times = {r["doc_id"]: r["_passes"] for r in mixing.mix(df)[0].collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    return [(i, len(ids := library.encode(t)), ids, True) for i, t, _, _ in rows for _ in range(times[i])]


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert sort(map(tuple, got.collect())) == sort(brute_pipeline(spark, SMALL))


def test_stages_take_awkward_rows(spark):
    """Also columns named like those that operators add themselves."""
    clash = [F.lit(k).alias(c) for k, c in enumerate(("_f", "_m", "_row", "_size", "_copy", "_j", "_passes", "row", "name", "rest", "kept_"))]
    docs = documents(spark).select("doc_id", "text", "lang", "source", F.col("n_chars"), *clash)
    for rows in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SMALL)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.schema.fieldNames() == docs.schema.fieldNames()
            assert (out.count() > 0) == (rows is docs)


def test_quote_signs_of_any_number(spark):
    """A line of very many signs is parsed like any other; only one blank after each counts."""
    lines = {">" * 100_000 + " a": (100_000, "a"), "> " * 100_000 + "b": (100_000, "b"), "> >  > c": (2, " > c"), " > d": (0, " > d"), ">\t>e": (2, "e"), "": (0, ""), ">": (1, "")}
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    got = {r["text"]: r["p"] for r in df.select("text", quotes.runs(F.col("text")).alias("p")).collect()}
    for line, (depth, rest) in lines.items():
        assert [(p["depth"], p["lines"]) for p in got[line]] == [(depth, [rest])], line[:20]
