"""Exact top-k against brute force."""

import math
import random

from waybill.llm.topk import exact_topk


def brute(rows, k=5, every=50, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a in ok:
        if i % every == 0:
            top = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), j) for j, b in ok if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(top)]
    return sorted(out)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, q string, score int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk(docs, **options).collect())
    assert got == brute(rows)


def test_odd_rows(spark):
    r = random.Random(1)
    vector = lambda: [r.gauss(0, 1) for _ in range(8)]
    rows = [(k, vector()) for k in range(300)]
    rows += [(None, vector()), (350, None), (400, [1.0, None] + vector()[:6]), (450, [float("nan")] * 8), (500, [float("inf")] + vector()[:7]), (550, [0.0] * 8), (600, []), (650, [2.0, 1.0])]
    rows += [(1000 + k, rows[7][1]) for k in range(12)]  # ties
    rows += [rows[7], rows[8]]  # repeated rows
    check(spark, rows)


def test_blocks_of_queries_and_few_rows(spark):
    r = random.Random(2)
    rows = [(k, [r.uniform(-1, 1) * 3 ** r.randrange(4) for _ in range(6)]) for k in range(0, 2000, 10)]
    check(spark, rows, query_block=7)
    check(spark, [(0, [1.0]), (1, [2.0]), (50, [3.0])])
    check(spark, [(50, [1.0, 2.0])])
    check(spark, [(7, [1.0, 2.0])])
    check(spark, [])


def test_large_components(spark):
    r = random.Random(3)
    check(spark, [(k, [r.uniform(-1, 1) * 10.0**e for e in (3, 7, 8)]) for k in range(0, 1000, 10)])
    check(spark, [(k, [r.uniform(-1, 1) * 1e9 for _ in range(4)]) for k in range(0, 1000, 25)])
