"""Exact dedup, mixing and line dedup on odd rows, against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from waybill.llm.exact_dedup import exact_dedup
from waybill.llm.line_dedup import line_dedup
from waybill.llm.mixing import mix_sources, mixed_documents, source_targets


def key(rows):
    return sorted(rows, key=repr)


# --- exact dedup --------------------------------------------------------------------
ROWS = [(1, "a", "x", 0), (2, "a", None, 0), (3, "b", "x", 0), (4, None, "x", 0), (5, "", "y", 0), (6, "c" * 300 + "1", "x", 0), (7, "c" * 300 + "2", "x", 0), (8, "c" * 300 + "1", "x", 0), (8, "c" * 300 + "1", "x", 0), (8, "c" * 300 + "1", "z", 0), (None, "b", "x", 0), (None, "d", "x", 0), (None, "d", "x", 0), (9, "é" * 50_000, "x", 0), (10, "é" * 50_000, "x", 0), (11, "a ", "x", 0)]
SCHEMA = "doc_id long, text string, keep_id string, _ int"


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_exact_dedup(spark, limit):
    """Both ways to find level-2 keys again: broadcast, and a shuffle."""
    out = exact_dedup(spark.createDataFrame(ROWS, SCHEMA), max_broadcast=limit)
    assert out.columns == ["doc_id", "text", "_", "keep_id", "group_size", "kept"]
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    best = {t: max((i for i in v if i is not None), default=None) for t, v in groups.items()}
    got = out.collect()
    assert key((r.doc_id, r.text, r.keep_id, r.group_size) for r in got) == key((i, t, best[t or ""], len(groups[t or ""])) for i, t, *_ in ROWS)
    assert Counter(r.text or "" for r in got if r.kept) == Counter(groups.keys())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_empty(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    assert exact_dedup(spark.createDataFrame([(1, "a", "", 0)], SCHEMA), carry=[]).collect()[0] == (1, 1, 1, True)


# --- mixing --------------------------------------------------------------------------
def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Deal by weight, cut at the cap, deal the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    rest, open_, target = share * sum(sizes.values()), list(order), {}
    while open_:
        level = rest / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, "c": 10, None: 7}, {"a": 1, "b": 1000, "c": 1000}, {"a": 0, "b": 0}, {"é": 5, "z": 500, "Z": 60, "": 3}, {"x": 12}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for limit in (10_000, 0):  # in one window, and in ranges
        got = {r.source: r.target for r in source_targets(rows, max_broadcast=limit).collect()}
        assert got == pytest.approx(plain_targets(sizes))


DOCS = [(k, "w " * (1 + (k * k) % 90), ["a", "b", "c", "d", None][k % 5], k) for k in range(400)] + [(1000, "w " * 5000, "a", 0), (1001, None, "a", 0), (1002, "", "b", 0), (None, "no id here", "c", 0), (None, "no id here", "c", 0), (7, "w " * (1 + 49 % 90), "c", 7)]


def test_mix(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string, size long")
    out = mix_sources(docs).collect()
    assert len(out) == len(DOCS)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert key((r.doc_id, r.source, r.size) for r in out) == key((i, s, size(t)) for i, t, s, _ in DOCS)
    total = defaultdict(int)
    for _, t, s, _ in DOCS:
        total[s] += size(t)
    want = plain_targets(total)
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == total[r.source] and r.target == pytest.approx(want[r.source])
    assert {s: (taken[s], round(want[s]), total[s]) for s in want if abs(taken[s] - want[s]) > max(size(t) for _, t, x, _ in DOCS if x == s) / 2} == {}
    again = mix_sources(docs.repartition(7), max_broadcast=0).collect()
    assert key(tuple(r) for r in out) == key(tuple(r) for r in again)
    odd = docs.withColumnRenamed("size", "_h")
    assert mixed_documents(odd).columns == odd.columns and {r._h for r in mixed_documents(odd).collect()} <= {r[3] for r in DOCS}
    texts = Counter((r.doc_id, r.text) for r in mixed_documents(docs).collect())
    assert sum(size(t) * n for (_, t), n in texts.items()) == sum(r.taken for r in out)
    assert mixed_documents(docs).columns == docs.columns


def test_mix_inclusion(spark):
    """Copies a document gets on average, over 60 sources of the same sizes, follow its size; a plain random order gives all the same."""
    sizes = [10 + 3 * k for k in range(60)] * 4
    rows = [(1000 * s + k, "w " * n, f"s{s:03d}") for s in range(60) for k, n in enumerate(sizes)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1,), share=1.2).collect()
    mean = Counter()
    for r in out:
        mean[r.size] += r.copies / 240
    m = {n: int(n**0.5 * 16) for n in sizes}
    c = 1.2 * sum(sizes) / sum(n * m[n] for n in sizes)  # none reaches the cap
    assert max(c * m[n] for n in sizes) < 2
    off = [abs(mean[n] - c * m[n]) for n in m]
    assert max(off) < 0.15 and sum(off) / 60 < 0.04 < 0.2 < sum(abs(1.2 - c * m[n]) for n in m) / 60


def test_mix_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(docs).collect() == [] and mixed_documents(docs).collect() == []


# --- line dedup -------------------------------------------------------------------------
def plain_lines(rows, ratio, least):
    pages, lines = Counter(), Counter()
    for _, t, h in rows:
        pages[h] += 1
        lines.update({(h, x.strip(" \t\r\f\v")) for x in (t or "").split("\n")} - {(h, "")})
    out = []
    for i, t, h in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        own = t.split("\n")
        kept = [x for x in own if not ((k := x.strip(" \t\r\f\v")) and lines[h, k] >= least and lines[h, k] / pages[h] > ratio)]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return out


@pytest.mark.parametrize("limit", [200_000, 0])
def test_line_dedup(spark, limit):
    rows = [(k, f"menu\n own {k} \nshared {k % 7}\n\n  menu\t\nmenu", ["h", "g", None][k % 3]) for k in range(60)]
    rows += [(100, None, "h"), (101, "", "h"), (102, "\n\n", "h"), (103, "menu", "alone"), (None, "menu\nx", "h"), (3, rows[3][1], rows[3][2]), (104, "long " * 50_000 + "\nmenu", "g")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, N_LINES int, _lines string")
    out = line_dedup(docs, max_ratio=0.2, min_pages=3, max_broadcast=limit)
    assert out.columns == ["doc_id", "text", "source", "_lines", "n_lines", "n_removed"]
    assert {r._lines for r in out.collect()} == {"k"}
    assert key((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()) == key(plain_lines(rows, 0.2, 3))
    assert line_dedup(docs.limit(0)).collect() == []
    assert hashlib.md5(b"").hexdigest() == "d41d8cd98f00b204e9800998ecf8427e"
