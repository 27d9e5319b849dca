"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Level 1 groups by byte length, level 2 by a hash of the first characters among
the lengths seen more than once, level 3 by SHA-256 of the whole text among the
(length, prefix) groups seen more than once. Rows that drop out at a level are
alone and never pass through a later one.

Levels 1 and 2 work on one narrow frame (length, prefix hash) that a first read
of the table leaves; a second read hashes the survivors' texts. Texts never move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut, few, hashable, join_groups, table, text_or_empty, without

MAX_BROADCAST = 1_000_000


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix_chars: int = 256, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Every row of ``docs``, with keep_id, group_size and kept.

    Of rows with equal text the one with the largest id stays; of several with
    that id, one (the largest by its other columns) stays. A null text counts as
    empty; a null id is smaller than any other; an empty table gives an empty
    result; input columns named like a result column are replaced. ``carry``:
    the columns to return besides the id (all by default).

    Keys of each level are broadcast only if there are at most ``max_broadcast``
    of them. With more (length, prefix) groups every text is hashed where it is
    read, since moving texts to their groups costs more; with more groups of
    equal texts, those over a 100,000th of their rows are broadcast and the rest
    joined by a shuffle. The table is read twice, three times if ``carry`` holds
    the text.
    """
    docs = without(docs, "keep_id", "group_size", "kept")
    carry = [c for c in (docs.columns if carry is None else carry) if c != id_col]
    extra = hashable(docs, [c for c in carry if c != text_col])
    keyed = docs.select(
        F.col(id_col).alias("_id"),
        text_or_empty(text_col).alias("_text"),
        F.struct(F.lit(0).alias("__wb_none"), *[F.col(f"`{c}`") for c in carry]).alias("_row"),
        (F.xxhash64(*[F.col(f"`{c}`") for c in extra]) if extra else F.lit(0)).cast("long").alias("_order"),
    ).withColumns({"_len": F.octet_length("_text"), "_pre": F.xxhash64(F.substring("_text", 1, prefix_chars))})

    sizes = cut(keyed.select("_len", "_pre"))
    lengths = cut(sizes.groupBy("_len").count().filter("count > 1").select("_len"))
    lengths = F.broadcast(lengths) if few(lengths, max_broadcast) else lengths
    prefixes = cut(sizes.join(lengths, "_len", "left_semi").groupBy("_len", "_pre").count().filter("count > 1").select("_len", "_pre", F.lit(True).alias("_more")))
    full = F.concat(F.sha2("_text", 256), F.lit(":"), F.col("_len").cast("string"))
    if few(prefixes, max_broadcast):
        marked = keyed.join(F.broadcast(prefixes), ["_len", "_pre"], "left").withColumn("_full", F.when(F.col("_more"), full))
    else:
        marked = keyed.withColumn("_full", full)
    # A row that dropped out has a key of its own, so that shuffles spread it.
    alone = F.concat(F.lit("-"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit("-"), F.col("_pre").cast("string"))
    marked = marked.select("_id", "_row", "_order", "_full", F.coalesce("_full", alone).alias("_key"))
    if text_col not in carry:
        marked = cut(marked)

    # Repeated rows are counted by themselves first: with the id in the key, a large group is many keys.
    own = marked.filter("_full is not null").groupBy("_key", "_id", "_order").agg(F.count("*").alias("_n"))
    groups = cut(own.groupBy("_key").agg(F.max(F.struct("_id", "_order", "_n")).alias("_top"), F.sum("_n").alias("group_size")).filter("group_size > 1"))
    rows = join_groups(marked, groups, "_key", "group_size", F.coalesce(F.col("_id").cast("string"), F.lit("")), max_broadcast)
    is_top = F.col("_top").isNull() | (F.col("_id").eqNullSafe(F.col("_top._id")) & (F.col("_order") == F.col("_top._order")))
    keep_id = F.when(F.col("_top").isNull(), F.col("_id")).otherwise(F.col("_top._id"))
    rows = rows.select("_id", "_row", "_key", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), is_top.alias("kept"), F.coalesce(F.col("_top._n") > 1, F.lit(False)).alias("_again"))
    out = [rows.select("_id", "_row", "keep_id", "group_size", "kept")]
    if not groups.filter("_top._n > 1").isEmpty():
        # A row to keep that is repeated as a whole is counted, not gathered, and one of it stays.
        several = F.col("kept") & F.col("_again")
        top = rows.filter(several).groupBy("_key").agg(F.first("_id").alias("_id"), F.first("_row").alias("_row"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.count("*").alias("_n"))
        top = top.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_id", "_row", "keep_id", "group_size", (F.col("_i") == 1).alias("kept"))
        out = [rows.filter(~several).select("_id", "_row", "keep_id", "group_size", "kept"), top]
    whole = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    return whole.select(F.col("_id").alias(id_col), *[F.col(f"_row.`{c}`").alias(c) for c in carry], "keep_id", "group_size", "kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(text_or_empty("text"), 256).alias("text_sha256"))
    return exact_dedup(docs, carry=["text_sha256"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
ORACLES = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))"""
}
