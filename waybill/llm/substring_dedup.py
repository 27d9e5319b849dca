"""Substring dedup on words by super-k-mer partitioning.

Consecutive windows of ``window`` words that share a minimiser (the smallest
hash of ``gram`` consecutive words in the window) travel as one packed string
to the minimiser's bucket. There windows are sorted by their hash, equal
neighbours are compared byte by byte, and each window gets the smallest
document in which it stands. See ``_repeats`` for the plan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from ._repeats import Plan, Prefix, Windows, mix, numbered, remove_repeats, told_apart


def sorted_windows(w: Windows):
    """Number windows by content: sort by hash, then compare bytes."""
    code = mix(Prefix(w.buf).of(w.start, w.end) + w.key.view(np.uint64))
    order = np.argsort(code)
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = code[order[1:]] != code[order[:-1]]
    return numbered(order, told_apart(w, order, fresh))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 8) -> DataFrame:
    """id, n_words, n_removed, n_spans, text (kept words joined by one space) of every row.

    A word goes if a window over it also starts in a document with a smaller id;
    windows are judged on the input. Null and empty texts have no words. Texts
    shorter than a window stay whole. A row without id stays whole and removes
    nothing. Rows with equal ids don't remove from each other. Other columns are
    not read. An empty table gives an empty result.
    """
    out = remove_repeats(docs, Plan("words", window, gram), sorted_windows, id_col, text_col)
    return out.select(id_col, F.col("n_units").alias("n_words"), "n_removed", "n_spans", F.col("kept").cast("string").alias("text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLES = {
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
        m AS (SELECT h, min(doc_id) AS low FROM s GROUP BY h),
        f AS (SELECT s.doc_id, s.i FROM s JOIN m ON s.h = m.h WHERE s.doc_id > m.low),
        p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        c AS (SELECT p.doc_id, p.i, word, max(CASE WHEN f.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
              FROM p LEFT JOIN f ON f.doc_id = p.doc_id AND f.i = p.i),
        g AS (SELECT doc_id, count(*) AS n, sum(gone) AS r, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
}
