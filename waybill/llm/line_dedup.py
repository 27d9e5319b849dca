"""Line dedup by site-relative frequency, with DataFrame functions only.

A line is boilerplate of a host if it stands on at least ``min_pages`` of the
host's pages and on more than ``max_ratio`` of them. Lines are compared after
trimming white space at both ends; blank lines are always kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut, few, table, text_or_empty, without

MAX_RATIO = 0.05
MIN_PAGES = 5
MAX_BROADCAST = 200_000


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", "")


def _key(line: Column) -> Column:
    return F.md5(_trimmed(line))


BLANK = "d41d8cd98f00b204e9800998ecf8427e"  # MD5 of an empty line


def boilerplate_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, line_key, n_pages, host_pages of every boilerplate line.

    A line counts once a page, and counts are combined before the shuffle, so a
    line on every page of a hot host costs one row a task.
    """
    pages = docs.select(F.col(host_col).cast("string").alias("host"), F.array_distinct(F.transform(F.split(text_or_empty(text_col), "\n"), _key)).alias("_keys"))
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = pages.select("host", F.explode("_keys").alias("line_key")).filter(F.col("line_key") != BLANK).groupBy("host", "line_key").agg(F.count("*").alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    return counts.join(totals.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h"))).drop("_h").filter(F.col("n_pages") / F.col("host_pages") > max_ratio)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with boilerplate lines gone from the text, and n_lines, n_removed.

    A null text stays null (no lines); an empty text is one blank line; a null
    host is a host of its own; repeated rows count as pages of their own; input
    columns named n_lines or n_removed are replaced. Boilerplate of a host is
    under (lines a page) / max_ratio lines; all of it is broadcast only if it is
    at most ``max_broadcast`` lines, else removed positions are joined by a
    shuffle.
    """
    docs = without(docs, "n_lines", "n_removed")
    found = cut(boilerplate_lines(docs, text_col, host_col, max_ratio, min_pages).select("host", "line_key"))
    lines = F.split(F.col(text_col).cast("string"), "\n")
    if few(found, max_broadcast):
        drop = found.groupBy(F.col("host").alias("__wb_host")).agg(F.collect_set("line_key").alias("__wb_drop"))
        rows = docs.join(F.broadcast(drop), F.col(host_col).cast("string").eqNullSafe(F.col("__wb_host")), "left").withColumn("__wb_lines", lines)
        kept = F.when(F.col("__wb_drop").isNull(), F.col("__wb_lines")).otherwise(F.filter("__wb_lines", lambda x: ~F.array_contains(F.col("__wb_drop"), _key(x))))
    else:
        ids = F.xxhash64(F.col(id_col), F.col(text_col))
        at = docs.select(F.col(id_col).alias("__wb_id"), ids.alias("__wb_row"), F.col(host_col).cast("string").alias("__wb_host"), F.posexplode(F.transform(lines, _key)).alias("__wb_pos", "__wb_key"))
        at = at.join(found, F.col("__wb_host").eqNullSafe(F.col("host")) & (F.col("__wb_key") == F.col("line_key")), "left_semi").groupBy("__wb_id", "__wb_row", "__wb_host").agg(F.collect_set("__wb_pos").alias("__wb_drop"))
        rows = docs.withColumns({"__wb_r": ids, "__wb_lines": lines}).join(at, F.col(id_col).eqNullSafe(F.col("__wb_id")) & (F.col("__wb_r") == F.col("__wb_row")) & F.col(host_col).cast("string").eqNullSafe(F.col("__wb_host")), "left")
        kept = F.when(F.col("__wb_drop").isNull(), F.col("__wb_lines")).otherwise(F.filter("__wb_lines", lambda x, i: ~F.array_contains(F.col("__wb_drop"), i)))
    rows = rows.withColumn("__wb_kept", kept)
    size = lambda c: F.coalesce(F.size(F.when(F.col(c).isNotNull(), F.col(c))).cast("long"), F.lit(0).cast("long"))
    counts = {"n_lines": F.when(F.col("__wb_lines").isNull(), F.lit(0).cast("long")).otherwise(size("__wb_lines")), "n_removed": F.when(F.col("__wb_lines").isNull(), F.lit(0).cast("long")).otherwise(size("__wb_lines") - size("__wb_kept"))}
    out = rows.withColumns(counts).withColumn("__wb_new", F.array_join("__wb_kept", "\n"))
    return out.select(*[F.col("__wb_new").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], "n_lines", "n_removed")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op10_line_dedup": op10_line_dedup}
ORACLES = {
    "op10_line_dedup": r"""
        WITH l AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        p AS (SELECT rowid_, doc_id, source, lines FROM (SELECT *, row_number() OVER () AS rowid_ FROM l)),
        e AS (SELECT rowid_, source, line, i FROM (SELECT rowid_, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM p)),
        k AS (SELECT rowid_, source, i, line, regexp_replace(line, '^[ \t\r\f\v]+|[ \t\r\f\v]+$', '', 'g') AS key FROM e),
        t AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
        b AS (SELECT k.source, key FROM (SELECT source, key, count(DISTINCT rowid_) AS n FROM k WHERE key <> '' GROUP BY ALL) k JOIN t ON t.source IS NOT DISTINCT FROM k.source WHERE n >= 5 AND n / total > 0.05),
        j AS (SELECT k.rowid_, k.i, k.line, b.key IS NOT NULL AS gone FROM k LEFT JOIN b ON b.source IS NOT DISTINCT FROM k.source AND b.key = k.key),
        g AS (SELECT rowid_, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM j GROUP BY rowid_)
        SELECT p.doc_id, p.source, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM p LEFT JOIN g ON p.rowid_ = g.rowid_"""
}
