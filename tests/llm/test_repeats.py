"""Substring and suffix-array dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import waybill.llm.suffix_dedup as suffix_module
from waybill.llm._repeats import Plan, Windows, remove_repeats
from waybill.llm.substring_dedup import sorted_windows, substring_dedup
from waybill.llm.suffix_dedup import sorted_suffixes, suffix_dedup


def brute(rows, units_of, window):
    """{(id, text): (units, removed, spans, kept units)}"""
    least = {}
    rows = [(i, t or "", units_of(t or "")) for i, t in rows]
    for i, _, u in rows:
        for k in range(len(u) - window + 1) if i is not None else ():
            w = tuple(u[k : k + window])
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t, u in rows:
        gone = [False] * len(u)
        for k in range(len(u) - window + 1) if i is not None else ():
            if least[tuple(u[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(u), sum(gone), spans, [x for x, g in zip(u, gone) if not g]))
    return out


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = ["wé", "b", "ccc", "d", "héé", "f", "x" * 30] + [f"w{k}" for k in range(200)]
    text = lambda n: r.choice(["", " ", "\t"]) + "".join(r.choice(vocabulary) + r.choice([" ", " ", "  ", "\n"]) for _ in range(n))
    shared = [text(n) for n in (12, 30, 60, 90)]
    rows = []
    for k in range(60):
        t = text(r.randrange(40))
        for _ in range(r.randrange(3)):
            t += r.choice(shared) + text(r.randrange(20))
        rows.append((r.randrange(100), t))
    rows += [(500 + k, rows[k % 7][1]) for k in range(20)]  # exact copies
    rows += [rows[3], (rows[4][0], rows[5][1]), (None, rows[6][1]), (700, None), (701, ""), (702, "ab" * 3000), (703, "b" + "ab" * 2000), (704, "same " * 500), (705, "the same " + "same " * 300)]
    return rows


def flat(rows):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


@pytest.mark.parametrize("window,gram", [(12, 4), (50, 8)])
def test_words(spark, window, gram):
    rows = corpus(window)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rid string, chunk int")
    got = [tuple(r) for r in substring_dedup(docs, window=window, gram=gram).collect()]
    assert flat(got) == flat([(i, n, g, s, " ".join(k)) for i, n, g, s, k in brute(rows, words, window)])


@pytest.mark.parametrize("window,gram", [(30, 16), (50, 20)])
def test_bytes(spark, window, gram):
    rows = corpus(window + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup(docs, window=window, gram=gram).collect()]
    assert flat(got) == flat([(i, n, g, s, bytes(k)) for i, n, g, s, k in brute(rows, lambda t: t.encode(), window)])


@pytest.mark.parametrize("kind,classes", [("words", sorted_windows), ("bytes", sorted_suffixes)])
def test_hot_minimisers_and_pieces(spark, monkeypatch, kind, classes):
    """Frequent minimisers are dealt by windows, and groups longer than a piece are read in pieces."""
    import waybill.llm._repeats as m

    monkeypatch.setattr(m, "HOT", 3)
    r = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(k, " ".join(f"w{r.randrange(999)}" for _ in range(20)) + " " + passage + " " + " ".join(f"w{r.randrange(999)}" for _ in range(20))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plan = Plan(kind, 50, 8 if kind == "words" else 20)
    got = [(x[0], x[1], x[2], x[3], hashlib.sha256(bytes(x[4])).hexdigest()) for x in remove_repeats(docs, plan, classes, "doc_id", "text", piece=2000).collect()]
    of, join = (words, lambda k: " ".join(k).encode()) if kind == "words" else (lambda t: t.encode(), bytes)
    assert flat(got) == flat([(i, n, g, s, hashlib.sha256(join(k)).hexdigest()) for i, n, g, s, k in brute(rows, of, 50)])


def test_long_texts_over_several_slices(spark):
    r = random.Random(9)
    long = [f"w{r.randrange(30000)}" for _ in range(70_000)]
    rows = [(2, " ".join(long)), (5, "before it " + " ".join(long[100:69_500]) + " and after"), (3, " ".join(long[65_500:65_560])), (9, "x" * 70_000 + "y" * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in substring_dedup(docs).collect()]
    assert flat(got) == flat([(i, n, g, s, " ".join(k)) for i, n, g, s, k in brute(rows, words, 50)])
    got = [(x[0], x[1], x[2], x[3], bytes(x[4])) for x in suffix_dedup(docs).collect()]
    assert flat(got) == flat([(i, n, g, s, bytes(k)) for i, n, g, s, k in brute(rows, lambda t: t.encode(), 50)])


@pytest.mark.parametrize("bits", [3, 64])
def test_large_groups_with_collisions(monkeypatch, bits):
    """Keys over a piece, by windows; with hashes of few bits most contents collide and only their bytes tell them apart."""
    import waybill.llm._repeats as m

    of = m.Prefix.of
    monkeypatch.setattr(m.Prefix, "of", lambda self, a, b: of(self, a, b) & np.uint64((1 << bits) - 1))
    r = random.Random(2)
    plan, rows = Plan("words", 10, 4), []
    for k in range(300):
        w = [f"a{r.randrange(4)}" for _ in range(4)] + ["m", "n", "o", "p"] + [f"b{r.randrange(3)}" for _ in range(8)]
        rows.append((7 if k < 200 else 8, k % 5, k, r.randrange(150), r.randrange(50), 4, " ".join(w).encode()))
    rows.sort(key=lambda x: (x[0], x[3]))
    names = ["key", "chunk", "rid", "id", "at", "anchor", "seg"]
    schema = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("rid", pa.int64()), ("id", pa.int64()), ("at", pa.int32()), ("anchor", pa.int32()), ("seg", pa.binary())])
    batches = pa.Table.from_pylist([dict(zip(names, x)) for x in rows], schema=schema).to_batches(max_chunksize=37)
    out = list(m._spans(plan, sorted_windows, piece=4000)(batches))
    cut = pa.Table.from_batches([b.cast(schema) for b in m._windows(plan, sorted_windows, piece=4000)(batches)]).sort_by([("key", "ascending"), ("id", "ascending")])
    assert cut.num_rows
    out += m._spans(plan, sorted_windows, True, piece=300)(cut.to_batches(max_chunksize=41))
    got = set()
    for b in out:
        for x in b.to_pylist():
            got |= {(x["rid"], k) for k in range(x["s"], x["e"] - plan.window + 1)}
    least, want = {}, set()
    for key, _, _, i, _, _, seg in rows:
        w = seg.split()
        for k in range(len(w) - 9):
            least[key, tuple(w[k : k + 10])] = min(least.get((key, tuple(w[k : k + 10])), i), i)
    for key, _, rid, i, at, _, seg in rows:
        w = seg.split()
        want |= {(rid, at + k) for k in range(len(w) - 9) if least[key, tuple(w[k : k + 10])] < i}
    assert got == want


def test_equal_windows_are_sorted_once(monkeypatch):
    """4,000 windows of three contents in one group, and one content in a group of its own."""
    r = random.Random(4)
    texts = [bytes(r.choice(b"ab") for _ in range(50)) for _ in range(3)]
    of = [r.randrange(3) for _ in range(4000)] + [0] * 50
    buf = np.frombuffer(b"".join(texts[k] for k in of) + bytes(16), np.uint8)
    start = np.arange(len(of)) * 50
    key = np.array([1] * 4000 + [2] * 50)
    w = Windows(buf, start, start + 50, np.arange(len(of)), np.zeros(len(of), int), key, np.zeros(len(of), int))
    sorted_, given = suffix_module.merge_sort, []
    monkeypatch.setattr(suffix_module, "merge_sort", lambda pre, buf, start, *a: given.append(len(start)) or sorted_(pre, buf, start, *a))
    number, order, starts = sorted_suffixes(w)
    assert given == [4]
    want = sorted(range(len(of)), key=lambda k: (key[k], texts[of[k]], k))
    assert order.tolist() == want and len(starts) == 4
    assert all((number[a] == number[b]) == ((key[a], of[a]) == (key[b], of[b])) for a, b in zip(want, want[1:]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(docs).collect() == [] and suffix_dedup(docs).collect() == []
