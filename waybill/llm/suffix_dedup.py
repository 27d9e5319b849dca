"""Suffix-array dedup on bytes by hash-compared suffix sort.

Suffixes that start a window are sorted within their minimiser's group by a
mergesort whose comparisons find the common extension of two suffixes by binary
search over prefix polynomial hashes, and then look at one byte. Suffixes whose
windows have one hash take part once, and these windows are verified byte by
byte. All groups of a batch are merged together, level by level. See ``_repeats`` for the plan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from ._repeats import Plan, Prefix, Windows, numbered, remove_repeats, told_apart


def _common(pre: Prefix, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to ``most``, the suffixes at a and b have in common."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), most, dtype=np.int64)
    whole = pre.of(a, a + most) == pre.of(b, b + most)
    low[whole] = most
    live = np.flatnonzero(~whole)
    high[live] = most - 1
    while len(live):
        mid = (low[live] + high[live] + 1) // 2
        same = pre.of(a[live], a[live] + mid) == pre.of(b[live], b[live] + mid)
        low[live[same]] = mid[same]
        high[live[~same]] = mid[~same] - 1
        live = live[low[live] < high[live]]
    return low


def _compare(pre: Prefix, buf: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """-1, 0 or 1 as the suffix at a is less than, equal to (in its first ``most`` bytes) or greater than that at b."""
    k = _common(pre, a, b, most)
    at = np.minimum(k, most - 1)
    return np.where(k == most, 0, np.sign(buf[a + at].astype(np.int16) - buf[b + at].astype(np.int16)))


def merge_sort(pre: Prefix, buf: np.ndarray, start: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """An order of the suffixes at ``start``, by group (ascending, contiguous in the input) and then first ``most`` bytes.

    Runs of a group double in length at each level. An element's place in the
    merged run is its own place plus its rank in the sibling run, found by
    binary search; equal elements of the left run come first.
    """
    order = np.arange(len(start))
    if not len(start):
        return order
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(begin, len(start)))
    width = 1
    while width < size.max():
        live = size > width
        of = np.repeat(begin[live], size[live])
        place = np.arange(len(of)) - np.repeat(np.cumsum(size[live]) - size[live], size[live])
        end = of + np.repeat(size[live], size[live])
        run = place // width
        low = np.minimum(of + (run ^ 1) * width, end)
        high = np.minimum(low + width, end)
        base, left = low.copy(), run % 2 == 0
        own = order[of + place]
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) // 2
            c = _compare(pre, buf, start[order[mid]], start[own[todo]], most)
            up = (c < 0) | ((c == 0) & ~left[todo])
            low[todo[up]] = mid[up] + 1
            high[todo[~up]] = mid[~up]
            todo = todo[low[todo] < high[todo]]
        to = of + (run // 2) * 2 * width + place % width + (low - base)
        order[to] = own
        width *= 2
    return order


def sorted_suffixes(w: Windows):
    """Number windows by content, from the sorted order of their suffixes."""
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = int(w.end[0] - w.start[0])
    pre = Prefix(w.buf)
    hashes = pre.of(w.start, w.start + most)
    # Equal windows have their minimiser at the same offset. Those with one hash compare as equal, so one of them is sorted for all.
    by = np.lexsort((hashes, w.offset, w.key))
    key, offset, hashes = w.key[by], w.offset[by], hashes[by]
    other = np.append(True, (key[1:] != key[:-1]) | (offset[1:] != offset[:-1]))
    first = np.flatnonzero(other | np.append(True, hashes[1:] != hashes[:-1]))
    inner = merge_sort(pre, w.buf, w.start[by[first]], np.cumsum(other)[first], most)
    size = np.diff(np.append(first, len(by)))[inner]
    begin = np.cumsum(size) - size
    order = by[np.repeat(first[inner] - begin, size) + np.arange(len(by))]
    fresh = np.zeros(len(order), dtype=bool)
    fresh[begin] = True
    return numbered(order, told_apart(w, order, fresh))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary) of every row.

    A byte goes if a string of ``window`` bytes over it also starts in a document
    with a smaller id; strings are judged on the input and never cross documents.
    Null texts are empty. Texts shorter than a window stay whole. A row without
    id stays whole and removes nothing. Rows with equal ids don't remove from
    each other. What is kept may break a character, so it is binary. Other
    columns are not read. An empty table gives an empty result.
    """
    if not 16 <= gram <= 24:
        raise ValueError("gram must be from 16 to 24 bytes")
    out = remove_repeats(docs, Plan("bytes", window, gram), sorted_suffixes, id_col, text_col)
    return out.select(id_col, F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_suffix_dedup": op4_suffix_dedup}
#: Bytes as pairs of hex digits.
ORACLES = {
    "op4_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        s AS (SELECT doc_id, i, substr(x, 2 * i - 1, 100) AS h FROM (SELECT doc_id, x, unnest(range(1, length(x) // 2 - 48)) AS i FROM d)),
        m AS (SELECT h, min(doc_id) AS low FROM s GROUP BY h),
        f AS (SELECT s.doc_id, s.i FROM s JOIN m ON s.h = m.h WHERE s.doc_id > m.low),
        p AS (SELECT doc_id, i, substr(x, 2 * i - 1, 2) AS b FROM (SELECT doc_id, x, unnest(range(1, length(x) // 2 + 1)) AS i FROM d)),
        c AS (SELECT p.doc_id, p.i, b, max(CASE WHEN f.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
              FROM p LEFT JOIN f ON f.doc_id = p.doc_id AND f.i = p.i),
        e AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 THEN 1 ELSE 0 END AS begins FROM c),
        g AS (SELECT doc_id, count(*) AS n, sum(gone) AS r, sum(begins) AS spans, string_agg(b, '' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
}
