"""String similarities from 0 to 100 by insertions and deletions (LCS).

``lcs`` and ``ratio_native`` are built-in expressions, kept as a cross-check.
The rest are Arrow UDFs over bit-parallel LCS, to be used on distinct pairs
that already share a key.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import ship

# Scales and length bounds of the weighted ratio.
PARTIAL_FROM, FAR_FROM = 1.5, 8.0
TOKEN_SCALE, PARTIAL_SCALE, FAR_SCALE = 0.95, 0.9, 0.6


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, as nested folds."""
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    bs = chars(b)

    def row(prev: Column, ca: Column) -> Column:
        step = lambda acc, j: F.concat(acc, F.array(F.when(F.get(bs, j) == ca, F.get(prev, j) + 1).otherwise(F.greatest(F.get(prev, j + 1), F.element_at(acc, -1)))))
        inner = F.when(F.size(bs) > 0, F.sequence(F.lit(0), F.size(bs) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(inner, F.array(F.lit(0)), step)

    zeros = F.array_repeat(F.lit(0), F.size(bs) + 1)
    return F.element_at(F.aggregate(chars(a), zeros, row), -1)


def ratio_native(a: Column, b: Column) -> Column:
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs(a, b) / total)


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel LCS (Hyyrö 2004): one addition a character of b."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against the longer's windows of its length, prefixes and suffixes included."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(*sorted((a, b), key=len))


def _windows(s: str, t: str) -> float:
    n, known, best = len(s), set(s), 0.0
    for start in range(1 - n, len(t)):
        lo, hi = max(0, start), min(len(t), start + n)
        # A window whose edge character the shorter string lacks is no better than the one inside it.
        edge = t[hi - 1] if start + n <= len(t) else t[lo]
        if edge in known:
            best = max(best, ratio(s, t[lo:hi]))
            if best == 100.0:
                break
    return best


def _sorted_tokens(a: str) -> str:
    return " ".join(sorted(a.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_sorted_tokens(a), _sorted_tokens(b))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 100.0
    core, p, q = (" ".join(sorted(z)) for z in (both, x - y, y - x))
    left, right = (core + " " + p if core else p), (core + " " + q if core else q)
    best = ratio(left, right)
    if core:
        best = max(best, ratio(core, left), ratio(core, right))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    best = partial_ratio(_sorted_tokens(a), _sorted_tokens(b))
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    return best if (p, q) == (_sorted_tokens(a), _sorted_tokens(b)) else max(best, partial_ratio(p, q))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    best, lengths = ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    if lengths < PARTIAL_FROM:
        return max(best, TOKEN_SCALE * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = PARTIAL_SCALE if lengths <= FAR_FROM else FAR_SCALE
    return max(best, scale * partial_ratio(a, b), TOKEN_SCALE * scale * partial_token_ratio(a, b))


def _udf(f):
    ship()

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[tuple, float | None] = {}
        out = []
        for pair in zip(a, b):
            if pair not in seen:
                seen[pair] = None if pair[0] is None or pair[1] is None else f(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return score


def ratio_udf(a: Column, b: Column) -> Column:
    return _udf(ratio)(a, b)


def partial_ratio_udf(a: Column, b: Column) -> Column:
    return _udf(partial_ratio)(a, b)


def token_sort_ratio_udf(a: Column, b: Column) -> Column:
    return _udf(token_sort_ratio)(a, b)


def token_set_ratio_udf(a: Column, b: Column) -> Column:
    return _udf(token_set_ratio)(a, b)


def weighted_ratio_udf(a: Column, b: Column) -> Column:
    return _udf(weighted_ratio)(a, b)
