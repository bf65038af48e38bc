"""Class model, spelling variants and conversation repair against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import class_lm, conversation_repair, spelling
from tests.llm.cases import SMALL, documents, empty, sort, words


def crc(text):
    return zlib.crc32(text.encode())


# --- class model --------------------------------------------------------------------------------


def between(big, cls, classes):
    out = np.zeros((classes, classes))
    np.add.at(out, (np.repeat(cls[:, None], len(cls), 1), np.repeat(cls[None], len(cls), 0)), big)
    return out


def test_exchange_gains():
    """What a move gains is the difference of the two likelihoods, for every word and class."""
    rng = np.random.default_rng(0)
    n, classes = 24, 5
    for _ in range(5):
        big, cls = rng.poisson(0.4, (n, n)).astype(float), rng.integers(0, classes, n)
        now = between(big, cls, classes)
        after, before = np.zeros((n, classes)), np.zeros((n, classes))
        for w, o in itertools.permutations(range(n), 2):
            after[w, cls[o]] += big[w, o]
            before[w, cls[o]] += big[o, w]
        best, gain = class_lm.best_classes(now, cls, after, before, np.diagonal(big).copy())
        for w in range(n):
            tried = []
            for c in range(classes):
                moved = cls.copy()
                moved[w] = c
                tried.append(class_lm.likelihood(between(big, moved, classes)) - class_lm.likelihood(now))
            assert gain[w] == pytest.approx(max(tried), abs=1e-6)
            assert tried[best[w]] == pytest.approx(max(tried), abs=1e-6)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_model(rows, model, rare, classes):
    """Scores of (id, text) rows: counts over the training rows, with the classes that were found."""
    held = [crc("" if i is None else str(i)) % 5 == 1 for i, _ in rows]
    texts = [[*words(lower(t)), None] for _, t in rows]
    name = lambda w: class_lm.END if w is None else class_lm.Words(*buffer(w)).hashes()[0]
    buffer = lambda w: (np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))
    count = Counter(w for h, t in zip(held, texts, strict=True) if not h for w in t)
    head = {int(k): int(n) for k, n in zip(model.head.keys, model.head.numbers, strict=True)}
    rare = {np.uint64(r["key"] % 2**64): r["c"] for r in rare}
    cls = {w: model.cls[head[int(name(w))]] if int(name(w)) in head else rare[name(w)] for w in count}
    in_head = {w: int(name(w)) in head for t in texts for w in t}

    def steps(t):
        state, apart = model.cls[0], 0
        for w in t:
            yield state + classes * apart, w
            state, apart = (model.cls[head[int(name(w))]], 0) if in_head[w] else (state, 1)

    known, once = defaultdict(Counter), Counter()
    for h, t in zip(held, texts, strict=True):
        if not h:
            for state, w in steps(t):
                known[state][cls[w]] += 1
                once[state] += count[w] == 1
    total = [sum(k[c] for k in known.values()) for c in range(classes)]
    overall = [n + 0.5 if n else 0 for n in total] + [sum(once.values()) + 0.5 * (sum(once.values()) > 0) + 0.5]
    share = [x / sum(overall) for x in overall]

    def log_p(state, w):
        whole = sum(known[state].values()) + once[state] + class_lm.PRIOR
        c = cls.get(w, classes)
        n = known[state][c] if w in cls else once[state]
        return math.log10((n + class_lm.PRIOR * share[c]) / whole) + (math.log10(count[w] / total[c]) if w in cls else 0)

    n_all, v = sum(count.values()), len(count)
    out = []
    for (i, _), h, t in zip(rows, held, texts, strict=True):
        base = sum(math.log10((count[w] + 0.5) / (n_all + 0.5 * (v + 1))) for w in t)
        out.append((i, h, len(t), sum(w in count for w in t), n_all, round(base, 6), round(sum(log_p(s, w) for s, w in steps(t)), 6)))
    return out


@pytest.mark.parametrize("head", [30, 5000])
def test_class_model_scores(spark, head):
    docs = documents(spark)
    model, rare = class_lm.fit(docs.where(~class_lm.held_out()), head_size=head, classes=6, rounds=2)
    got = class_lm.score(docs, model, rare).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = brute_model(rows, model, rare.where("kind = 0").collect(), 6)
    for a, b in zip(sort(map(tuple, got)), sort(expected), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], atol=1e-4), (a, b)


def test_class_model_is_a_distribution(spark):
    """After every history, all known words and the unknown one share 1."""
    docs = documents(spark)
    model, rare = class_lm.fit(docs, head_size=50, classes=6, rounds=1)
    follows = 10**model.follows
    assert np.allclose(follows.sum(1), 1)
    inside = np.zeros(6)
    np.add.at(inside, model.cls, model.head.n)
    for r in rare.where("kind = 0").collect():
        inside[r["c"]] += r["n"]
    assert (inside == model.size).all() and inside.sum() == model.tokens


def test_class_model_held_out(spark):
    """Texts that weren't learned from are likelier than by single words, and copies of the table don't change the result."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model, rare = class_lm.fit(docs.where(~class_lm.held_out()), rounds=3)
    sums = class_lm.score(docs, model, rare).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert sums[1] / sums[2] > sums[0] / sums[2] + 0.8


def test_class_model_empty(spark):
    docs = empty(spark)
    model, rare = class_lm.fit(docs, rounds=1)
    assert class_lm.score(docs, model, rare).collect() == []
    got = class_lm.score(documents(spark), model, rare).collect()
    assert len(got) == documents(spark).count() and all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in got)


# --- spelling -----------------------------------------------------------------------------------


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(rows):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = crc(f"{'' if i is None else i}:{run}")
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    form, n_near = {}, {}
    for w in count:
        others = [x for x in count if near(w, x)]
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 10 * count[w] else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], form[w] and count[form[w]]))
    return out


def spelled(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abçdé") for _ in range(rng.randint(7, 10))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(base) for _ in range(60)) + ". Ünïted-" + base[k % 9].upper() + " x" * (k % 5)) for k in range(150)]
    for k in range(40):  # near words of the most frequent ones, and near words of those
        w = base[k % 5]
        at = rng.randrange(len(w))
        v = w[:at] + rng.choice(["", "zz"[:1], "ÿ" + w[at]]) + w[at + 1 :]
        rows.append((1000 + k, f"{v} {v} {v[:3]}q{v[3:]} " * 3))
    rows += [(None, base[0]), (None, None), (7, ""), (7, "short"), (3, "abcdefgh" * 700 + " " + "abcdefgh" * 700), (5, f"{base[1]} " * 3000), (5, f"{base[1]} " * 3000)]
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, word string, n long, gram long"), rows


@pytest.mark.parametrize("frequent,size", [(1000, 1 << 16), (0, 1 << 16), (3, 200), (5, 3)])
def test_spelling(spark, frequent, size):
    docs, rows = spelled(spark)
    got = spelling.spelling_forms(docs, frequent=frequent, size=size).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sort(map(tuple, got)) == sort(brute_spelling(rows))


def test_spelling_words_without_a_bound(spark, monkeypatch):
    """Words whose grams may all be affected are met by what is left of them."""
    monkeypatch.setattr(spelling.Grams, "bound", lambda self, s, grams: len(grams))
    docs, rows = spelled(spark)
    docs, rows = docs.where("length(text) < 5000"), [r for r in rows if len(r[1] or "") < 5000]
    got = spelling.spelling_forms(docs).collect()
    assert sort(map(tuple, got)) == sort(brute_spelling(rows))


def test_affected_grams():
    """Grams beyond the bound stand in every word one edit away, at the same place or moved with the edit."""
    rng = random.Random(1)
    for _ in range(30):
        letters = "abcde"[: rng.choice([2, 3, 5])]
        grams = {g + x for g in map("".join, itertools.product(letters + spelling.FIRST + spelling.LAST, repeat=3)) if rng.random() < 0.4 for x in ("", rng.choice(letters))}
        index = spelling.Grams(grams)
        for _ in range(100):
            w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 14)))
            i = rng.randrange(len(w))
            v = w[:i] + rng.choice([rng.choice(letters) + w[i:], w[i + 1 :], rng.choice(letters) + w[i + 1 :]])
            marked = [spelling.FIRST + x + spelling.LAST for x in (w, v)]
            a, b = ({(p, s[p : p + q]) for p, q in index.decompose(s)} for s in marked)
            shift = len(v) - len(w)
            same = sum((p, g) in b if p + len(g) <= i + 1 else p > i and (p + shift, g) in b for p, g in a)
            assert same >= len(a) - index.bound(marked[0], index.decompose(marked[0]))


def test_spelling_empty(spark):
    assert spelling.spelling_forms(empty(spark)).collect() == []


# --- conversation repair ------------------------------------------------------------------------


def brute_path(symbols):
    """Least cost and least audit, layer by layer."""
    layer = {0: (0, "")}
    for i in range(len(symbols) + 1):
        for _ in range(3):
            for q, (c, a) in list(layer.items()):
                t = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                layer[t] = min(layer.get(t, (c + 3, a + "I")), (c + 3, a + "I"))
        if i == len(symbols):
            return min(layer[q] for q in (0, 3) if q in layer)
        s, after = symbols[i], {}
        cut = 3 if s.isupper() else 0
        for q, (c, a) in layer.items():
            ways = [("D", 4, q)]
            if s not in "bd":
                due = 3 if q == 2 else 2
                ways.append(("R", 3 + cut, due))
                keeps = {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(s.lower())
                if keeps:
                    ways.append(("K", cut, keeps))
            for letter, cost, t in ways:
                after[t] = min(after.get(t, (c + cost, a + letter)), (c + cost, a + letter))
        layer = after


def brute_repair(rows):
    """Per conversation id (gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of (conv, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv]
        role, text = role or " " if role is None else role, " " if text is None else text
        k = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            by[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        symbols, seen = "", set()
        for _, role, text in turns:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            low = role[:1] if role[:1] in ("s", "u", "a") and role else "x"
            symbols += "b" if not last else "d" if (role, text) in seen else low if last in ".!?" else low.upper()
            seen.add((role, text))
        cost, audit = brute_path(symbols)
        lines, state, left = [], 0, iter(turns)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            role = row[1] if letter == "K" else ["user", "user", "assistant", "user"][state]
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{row[2] if row else ''}")
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out.append((conv, gaps, symbols.count("b"), symbols.count("d"), sum(map(str.isupper, symbols)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def talks(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]) if conv % 3 else "ua"[turn % 2].replace("u", "user").replace("a", "assistant")
            text = rng.choice(["Yes.", "No!", "so", "Why?\n", " ", "A longer answer. " * rng.randint(1, 4) + "é"])
            rows.append((conv, turn if rng.random() < 0.95 else turn + 3, role, text))
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Hello."), (None, None, "assistant", "Hello."), (None, 2, None, None), (70, 1, "", "x"), (71, None, None, None), (72, 5, "user", "x. " * 9000)]
    rows += [(80, t, "user" if t % 2 else "assistant", rng.choice(["a.", "b", "c!", "", "d e f?"]) if t % 5 else f"{t}.") for t in range(700)]  # a conversation that holds most rows
    rows += [(81, 1, "user", "Same.")] * 50
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, at long, symbols string"), rows


@pytest.mark.parametrize("shift", [10, 3, 1])
def test_repair(spark, monkeypatch, tmp_path, shift):
    """Conversations of one block, and of up to hundreds."""
    monkeypatch.setattr(conversation_repair, "SHIFT", shift)
    turns, rows = talks(spark)
    monkeypatch.setattr(conversation_repair, "table", lambda *a: turns)
    got = conversation_repair.op13_conversation_repair(spark, "").collect()
    assert sort(map(tuple, got)) == sort(brute_repair(rows))


def test_search_meets_in_the_middle():
    """All short rows of symbols, and random longer ones."""
    rng = random.Random(3)
    cases = ["".join(c) for n in range(1, 5) for c in itertools.product("bduaxsUA", repeat=n) if rng.random() < (1 if n < 4 else 0.2)]
    cases += ["".join(rng.choice("bdsuaxSUAXuaua") for _ in range(rng.randint(5, 30))) for _ in range(400)]
    for symbols in cases:
        assert conversation_repair.whole(symbols) == brute_path(symbols), symbols


def test_repaired_turns(spark):
    """The turns themselves hash to what the report says."""
    rows = conversation_repair.damaged(talks(spark)[0])
    report = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.repair_report(rows).collect()}
    lines = defaultdict(list)
    for r in sorted(conversation_repair.repaired_turns(rows).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "KRI"
    assert report == {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in report}


def test_repair_empty(spark):
    none = talks(spark)[0].where("false")
    assert conversation_repair.repair_report(none).collect() == conversation_repair.repaired_turns(none).collect() == []
