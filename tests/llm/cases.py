"""Small tables with the awkward rows every operator must take, and brute-force results."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(text or "")


def documents(spark):
    """Nulls, empty, long, repeated and near-equal rows, and extra columns with clashing names."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(200), prose(60)
    near = base.split()
    near[50] = "changed"
    lines = "same line\nsame line\n\nsame line " + prose(40)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(30) + " " + passage + "\n" + prose(20)), (5, passage + " " + prose(10)),
        (6, ""), (7, None), (8, " \t\n\x0b\f\r "), (9, "one"), (10, "one"), (11, "one two"), (12, "One TWO"), (13, "É é É"), (14, "é é é"),
        (15, prose(6000)), (16, "x" * 5000 + " " + prose(30)), (17, lines), (17, lines),
        (None, prose(80)), (None, base), (19, base), (19, base), (20, "a b " * 60), (21, "a b c　d"), (22, "𝄞 ▁ tab\there > quoted"),
    ]
    rows = [(i, t, "en" if k % 3 else None, None if k % 7 == 0 else f"s{k % 4}", len(t or ""), k, "clash", 1.5) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, kept string, size double")


def empty(spark):
    return documents(spark).where("false")


def removed(texts, window=35):
    """Per text the kept words, judged on all texts."""
    lists = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def shingles(text, n=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def groups(rows, percent=90, n=3):
    """``rows`` of (id, text): per row (id, set size, smallest id reachable)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            ids[find(i)].append(id_)
    return [(id_, len(sets[i]), min(ids[find(i)], default=None) if sets[i] else id_) for i, (id_, _) in enumerate(rows)]


def sha(tokens):
    return hashlib.sha256(" ".join(tokens).encode()).hexdigest()


def sort(rows):
    return sorted(rows, key=lambda r: [(x is None, str(type(x)), x if not isinstance(x, (list, dict)) else str(x)) if x is not None else (True, "", 0) for x in r])
