"""Near-duplicate classes against brute force; signatures against similarities."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from waybill.llm.near_dedup import near_dedup, signatures


def cells(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, weighted):
    texts = sorted({t or "" for _, t in rows})
    sets = {t: cells(t) for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = sets[a], sets[b]
            if x and y:
                s = sum((x & y).values()) / sum((x | y).values()) if weighted else len(x.keys() & y.keys()) / len(x.keys() | y.keys())
                if s >= 0.8:
                    root[find(a)] = find(b)
    groups = {}
    for i, t in rows:
        groups.setdefault(find(t or ""), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return [(i, least[find(t or "")], len(groups[find(t or "")])) for i, t in rows]


def corpus(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    rows, k = [], 0
    for _ in range(25):
        base = [word() for _ in range(r.choice([3, 5, 6, 40, 200, 1500]))]
        for _ in range(r.randrange(1, 7)):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, len(own) // 60, len(own) // 30])):
                own[r.randrange(len(own))] = word()
            rows.append((k, r.choice([" ", "\n"]).join(own)))
            k += 1
    passage = " ".join(word() for _ in range(60))
    rows += [(1000 + j, " ".join(word() for _ in range(40)) + " " + passage) for j in range(15)]
    line = " ".join(word() for _ in range(7)) + "\n"
    rows += [(2000 + j, line * (10 + j)) for j in range(6)]
    rows += [(3000, None), (3001, ""), (3002, " "), (3003, "a"), (3004, "a"), (None, rows[0][1]), (None, "nothing like it at all"), rows[1], (5000, rows[2][1]), (5000, rows[9][1])]
    return rows


def order(rows):
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


@pytest.mark.parametrize("weighted", [False, True])
def test_classes(spark, weighted):
    rows = corpus(7)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, kept int")
    out = near_dedup(docs, weighted=weighted).collect()
    assert out[0].__fields__ == ["doc_id", "text", "node", "class_id", "class_size", "kept"]
    assert order((x.doc_id, x.class_id, x.class_size) for x in out) == order(brute(rows, weighted))
    kept = Counter(x.class_id for x in out if x.kept)
    assert all(x.doc_id == x.class_id for x in out if x.kept)
    assert {c for c in kept if c is not None} == {x.class_id for x in out} - {None} and all(n == 1 for c, n in kept.items() if c is not None)


def test_large_buckets_in_blocks(spark):
    r = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(80):
        own = list(base)
        own[r.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order((x.doc_id, x.class_id, x.class_size) for x in near_dedup(docs, cap=10).collect()) == [(k, 0, 80) for k in range(80)]


def spread(seed, n):
    """Copies of one text with six or seven of 60 edits, so most pairs lie just below 0.8 and few above."""
    r = random.Random(seed)
    made = [[f"w{k}" for k in range(300)]]
    for _ in range(n - 1):
        own = list(made[0])
        for k in r.sample(range(60), r.randrange(6, 8)):
            own[5 + 290 * k // 60] = f"x{k}"
        made.append(own)
    return [" ".join(x) for x in made]


def connected(texts):
    """Each text's class by brute force, named by its smallest position."""
    ids, rows = {}, []
    for t in texts:
        w = t.split()
        rows.append([ids.setdefault(tuple(w[k : k + 5]), len(ids)) for k in range(len(w) - 4)])
    m = np.zeros((len(texts), len(ids)), np.float32)
    for k, row in enumerate(rows):
        m[k, row] = 1
    both, size = m @ m.T, m.sum(axis=1)
    linked = both / (size[:, None] + size - both) >= 0.8 - 1e-9
    label = np.arange(len(texts))
    while True:
        least = np.where(linked, label, len(texts)).min(axis=1)
        if (least == label).all():
            return label
        label = least


@pytest.mark.parametrize("n,cap,visitors", [(600, 1024, 4), (300, 50, 4), (300, 20, 1)])
def test_links_behind_rejected_candidates(spark, n, cap, visitors):
    """Similarities around 0.8 in one bucket, in blocks with visitors, and in buckets split by further bands."""
    texts = spread(1, n)
    label = connected(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((x.doc_id, x.class_id) for x in near_dedup(docs, cap=cap, visitors=visitors).collect())
    assert got == [(k, int(c)) for k, c in enumerate(label)]


@pytest.mark.parametrize("cap", [512, 16])
def test_classes_around_the_threshold(spark, cap):
    """Several families of copies with similarities of 0.75 to 0.85, against brute force."""
    r = random.Random(5)
    texts = []
    for f in range(6):
        base = [f"f{f}w{k}" for k in range(200)]
        for _ in range(40):
            own = list(base)
            for k in r.sample(range(38), r.randrange(2, 6)):
                own[5 + 5 * k] = f"x{r.randrange(10**9)}"
            texts.append(" ".join(own))
    label = connected(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in near_dedup(docs, cap=cap).collect()}
    assert [got[k] for k in range(len(texts))] == label.tolist()


def test_empty_and_single(spark):
    assert near_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    out = near_dedup(spark.createDataFrame([(5, "some words")], "doc_id long, text string")).collect()
    assert [tuple(x) for x in out] == [(5, "some words", 5, 1, True)]


@pytest.mark.parametrize("kind", ["set", "count", "real"])
def test_signatures_estimate_similarity(kind):
    r = np.random.default_rng(1)
    k = 4000
    for n, share in ((3, 0.5), (50, 0.8), (3000, 0.8), (3000, 0.2)):
        names = r.integers(1, 2**63, n, dtype=np.uint64)
        weigh = lambda: {"set": np.ones(n), "count": r.integers(1, 5, n).astype(float), "real": r.uniform(0.1, 3, n)}[kind]
        a, b = weigh(), weigh()
        lost = r.random(n) > share
        b[lost] = 0
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        doc = np.concatenate([np.zeros(n, int), np.ones((b > 0).sum(), int)])
        s = signatures(doc, np.concatenate([names, names[b > 0]]), np.concatenate([a, b[b > 0]]), 2, k)
        assert (s != 0).all()
        assert abs((s[0] == s[1]).mean() - exact) < 0.04


def test_large_buckets_are_not_split(spark):
    """One band: splitting a bucket by the bands that follow would lose every link behind the first candidates."""
    texts = spread(1, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = lambda **kw: sorted((x.doc_id, x.class_id) for x in near_dedup(docs, bands=1, rows=1, **kw).collect())
    assert classes(cap=20, visitors=1) == classes(cap=1024)
