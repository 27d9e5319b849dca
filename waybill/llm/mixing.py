"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Each source gets a target number of words by water filling. Within a source a
document wants ``c * m`` copies, at most ``cap``, where its measure ``m`` grows
with the square root of its size and ``c`` makes the wanted words the target:
longer documents are wanted more often. The whole part is given as certain
copies; the fraction ``p`` is the document's inclusion probability in a sample
whose size is fixed in words. Documents are ranked by Pareto's variable, the odds of
a uniform number (a keyed hash of the id) over the odds of ``p``, and taken in
that order until the source's remaining words are filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import WORD, cut, few, partitions, table, text_or_empty

#: Steps of the rank in which words are summed before rows are ordered.
STEPS = 1024
#: Measures are whole numbers, so that their sums are exact: so many to the square root of a word.
MEASURE = 16
#: Filling rounds. The first takes a run of the order; if a long document at its end leaves over NEAR of the target, shorter ones fill that.
ROUNDS, NEAR = 3, 0.005
#: Sources whose targets are broadcast, at most (about 50 bytes each); more are joined by a shuffle.
MAX_BROADCAST = 10_000


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _ranged(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with ``_part``: consecutive ranges of the order, one a partition."""
    return cut(rows.repartitionByRange(partitions(rows.sparkSession), *order).withColumn("_part", F.spark_partition_id()))


def _before(rows: DataFrame, **sums: Column) -> DataFrame:
    """For each ``_part`` the sums of all parts before it; there are as many parts as partitions."""
    parts = rows.groupBy("_part").agg(*[f.alias(name) for name, f in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(parts.select("_part", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums]))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """source, source_size -> target: ``share`` of all words dealt by weight, none above ``cap`` times its source.

    Reference loop: deal by weight, cut at the cap, deal the excess again, until
    none is above. Its fixed point is a water level: with sources in order of
    cap / weight, the level is the largest rest / (weight of those not yet full)
    that the source at which it is taken does not undercut. Up to
    ``max_broadcast`` sources are numbered and summed in one window; more in
    ranges, with the sums of the ranges before.
    """
    sizes = cut(sizes)
    one_window = few(sizes, max_broadcast)
    by_name = F.col("source").asc_nulls_last()
    if one_window:
        numbered = sizes.withColumn("_k", F.row_number().over(Window.orderBy(by_name)))
    else:
        ranged = _ranged(sizes, by_name)
        numbered = ranged.join(_before(ranged, _b=F.count("*")), "_part").withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy(by_name)) + F.col("_b")).drop("_part", "_b")
    sized = numbered.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_k") - 1) % len(weights) + 1).cast("int"))).withColumn("_cap", F.col("source_size") * F.lit(cap)).drop("_k")
    totals = sized.agg(F.sum("source_size").alias("s"), F.sum("_w").alias("w")).first()
    order = [F.col("_cap") / F.col("_w"), by_name]
    if one_window:
        window, before = Window.orderBy(*order), sized.withColumns({"_caps0": F.lit(0), "_weights0": F.lit(0)})
    else:
        ranged = _ranged(sized, *order)
        window, before = Window.partitionBy("_part").orderBy(*order), ranged.join(_before(ranged, _caps0=F.sum("_cap"), _weights0=F.sum("_w")), "_part")
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    caps = F.col("_caps0") + F.coalesce(F.sum("_cap").over(earlier), F.lit(0))
    used = F.col("_weights0") + F.coalesce(F.sum("_w").over(earlier), F.lit(0))
    filled = cut(before.withColumns({"_rest": F.lit(float(totals.s or 0)) * share - caps, "_weights": F.lit(totals.w or 0) - used}))
    level = filled.agg(F.max(F.when(F.col("_cap") / F.col("_w") >= F.col("_rest") / F.col("_weights"), F.col("_rest") / F.col("_weights")))).first()[0]
    level = F.lit(level).cast("double")
    return filled.select("source", "source_size", F.when(level.isNull() | (level * F.col("_w") > F.col("_cap")), F.col("_cap").cast("double")).otherwise(level * F.col("_w")).alias("target"))


def measure(size: Column) -> Column:
    return F.floor(F.sqrt(size.cast("double")) * MEASURE).cast("long")


def _wanted(base: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """source -> c, of which a document wants c * measure copies (null: ``cap`` copies).

    One row a source and size, longest first: once those before it are at the
    cap, ``c`` fills the target from the rest. The first whose own wish then
    stays within the cap has the right one.
    """
    kinds = base.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    kinds = kinds.withColumns({"m": measure(F.col("size")), "words": F.col("size") * F.col("n")}).withColumn("weight", F.col("words").cast("decimal(38,0)") * F.col("m"))
    window = Window.partitionBy("source").orderBy(F.desc("size"))
    sums = kinds.withColumns({"_full": F.coalesce(F.sum("words").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_open": F.sum("weight").over(window.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    named = sums.withColumnRenamed("source", "_k").join(targets, F.col("_k").eqNullSafe(F.col("source")))
    level = (F.col("target") - F.col("_full") * F.lit(cap)) / F.col("_open").cast("double")
    return named.withColumn("c", level).filter((F.col("c") * F.col("m") <= cap) & (F.col("c") >= 0)).groupBy("_k").agg(F.max_by("c", "size").alias("c"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "mix", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row for each row of ``docs``: its id, size, source_size, target, taken, source, copies, text_hash (SHA-256).

    The same rows and seed give the same mix. Null text: size 0, never taken. A
    null source is a source of its own, the last in order. Null ids hash as the
    word null; rows with one id rank by size, then text. Other columns are not
    read. An empty table gives an empty result. A hot source is summed in
    ``STEPS`` steps of the rank, so that no task orders all its rows. Of a source
    no document is taken more than ``cap`` times.
    """
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(text, 256)).alias("text_hash"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    base = cut(base.withColumn("_u", u))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, share, cap, max_broadcast))
    targets = cut(targets.join(_wanted(base, targets, cap), F.col("source").eqNullSafe(F.col("_k")), "left").drop("_k"))
    # A broadcast keeps a hot source's rows where they are; sources can outnumber what it may hold.
    held = F.broadcast if few(targets, max_broadcast) else lambda df: df
    wish = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.least(F.coalesce(F.col("c") * measure(F.col("size")), F.lit(float(cap))), F.lit(float(cap))))
    rows = base.join(held(targets.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_want", wish).drop("c")
    rows = rows.withColumn("_whole", F.floor("_want")).withColumn("_p", F.col("_want") - F.col("_whole"))
    odds = (F.col("_u") / (1 - F.col("_u"))) / F.when(F.col("_p") > 0, F.col("_p") / (1 - F.col("_p")))
    rows = rows.withColumn("_rank", odds).withColumns({"_step": F.floor(F.coalesce(F.col("_rank") / (1 + F.col("_rank")), F.col("_u")) * STEPS), "_taken": F.lit(False)}).drop("_want")
    certain = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_whole")).alias("_certain"))
    left = cut(targets.join(certain.withColumnRenamed("source", "_k"), F.col("source").eqNullSafe(F.col("_k"))).select(F.col("source").alias("_s"), (F.col("target") - F.col("_certain")).alias("_left")))
    for k in range(ROUNDS):
        rows, left = _fill(rows, held(left), last=k == ROUNDS - 1)
    copies = F.col("_whole") + F.col("_taken").cast("long")
    return rows.select(F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source", copies.alias("copies"), "text_hash")


def _fill(rows: DataFrame, left: DataFrame, last: bool) -> tuple[DataFrame, DataFrame]:
    """Take open rows in rank order while their words fit in what is left of each source.

    While over NEAR of the target is left, rows that can't fit are passed over.
    Only the last round may pass the mark, by a document that so comes nearer.
    """
    rows = rows.join(left, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    near = F.col("_left") <= F.col("target") * NEAR
    fits = ~F.col("_taken") & (F.col("_p") > 0) & (F.col("size") > 0) & (near | (F.col("size") <= F.col("_left") * (2 if last else 1)))
    rows = rows.withColumn("_fits", fits).withColumn("_add", F.when(fits, F.col("size")).otherwise(F.lit(0)))
    steps = rows.groupBy("source", "_step").agg(F.sum("_add").alias("_words"))
    before = steps.select(F.col("source").alias("_s"), F.col("_step").alias("_t"), F.coalesce(F.sum("_words").over(Window.partitionBy("source").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rows = rows.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_step") == F.col("_t"))).drop("_s", "_t")
    within = Window.partitionBy("source", "_step").orderBy("_rank", "_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = F.col("_before") + F.sum("_add").over(within)
    take = F.col("_fits") & ((words - F.col("size") / 2 if last else words) <= F.col("_left"))
    rows = rows.withColumn("_now", take).withColumn("_taken", F.col("_taken") | F.col("_now"))
    if last:
        return rows, left
    rows = cut(rows)
    now = rows.filter("_now").groupBy(F.col("source").alias("_n")).agg(F.sum("size").alias("_got"))
    left = left.join(now, F.col("_s").eqNullSafe(F.col("_n")), "left").select("_s", (F.col("_left") - F.coalesce("_got", F.lit(0))).alias("_left"))
    return rows.drop("_left", "_fits", "_add", "_before", "_now"), left


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it was taken, columns unchanged.

    Texts are moved once, by id and text hash. Rows equal in id, text and source share one decision each.
    """
    mix = mix_sources(docs, id_col, text_col, source_col, **options)
    # Equal rows (id, text, source) may be taken differently; together they make one entry that is dealt over them by rank.
    counted = mix.groupBy(F.col(id_col).alias("__wb_m_id"), F.col("text_hash").alias("__wb_m_hash"), F.col("source").alias("__wb_m_source")).agg(F.max("copies").alias("__wb_m_copies"), F.max(F.when(F.col("copies") > 0, F.lit(1))).alias("__wb_any"), F.sum("copies").alias("__wb_m_all"), F.count("*").alias("__wb_m_rows"))
    held = docs.withColumns({"__wb_h": F.unhex(F.sha2(text_or_empty(text_col), 256)), "__wb_s0": F.col(source_col).cast("string")})
    joined = held.join(counted, F.col(id_col).eqNullSafe(F.col("__wb_m_id")) & (F.col("__wb_h") == F.col("__wb_m_hash")) & F.col("__wb_s0").eqNullSafe(F.col("__wb_m_source")))
    one = joined.filter("__wb_m_rows = 1").withColumn("__wb_times", F.col("__wb_m_all"))
    order = Window.partitionBy("__wb_m_id", "__wb_m_hash", "__wb_m_source").orderBy(F.lit(0))
    more = joined.filter("__wb_m_rows > 1").withColumn("__wb_k", F.row_number().over(order) - 1).withColumn("__wb_times", F.floor(F.col("__wb_m_all") / F.col("__wb_m_rows")) + (F.col("__wb_k") < F.col("__wb_m_all") % F.col("__wb_m_rows")).cast("long")).drop("__wb_k")
    out = one.unionByName(more).filter("__wb_times > 0").withColumn("__wb_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__wb_times"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


QUERIES = {"op7_mix_sources": op7_mix_sources}


def _round(k: int, last: bool) -> str:
    fits = f"NOT taken AND p > 0 AND size > 0 AND (lft <= target * {NEAR}::DOUBLE OR size <= lft * {2 if last else 1})"
    return f"""
        l{k} AS (SELECT *, target - sum(size * whole) OVER (PARTITION BY source)::BIGINT - sum(CASE WHEN taken THEN size ELSE 0 END) OVER (PARTITION BY source)::BIGINT AS lft FROM r{k}),
        c{k} AS (SELECT *, {fits} AS fits, sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS FIRST, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum FROM l{k}),
        r{k + 1} AS (SELECT doc_id, source, size, source_size, target, whole, p, rank, taken OR (fits AND cum {'- size / 2' if last else ''} <= lft) AS taken FROM c{k})"""


ORACLES = {
    "op7_mix_sources": rf"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * 2 AS cap FROM s),
        f AS (SELECT *, (sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
                     (sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS ws FROM w),
        v AS (SELECT *, max(CASE WHEN cap / w >= rest / ws THEN rest / ws END) OVER () AS lev FROM f),
        t AS (SELECT source, source_size, CASE WHEN lev IS NULL OR lev * w > cap THEN cap::DOUBLE ELSE lev * w END AS target FROM v),
        k AS (SELECT source, size, count(*) * size AS words, floor(sqrt(size::DOUBLE) * {MEASURE})::BIGINT AS m FROM d WHERE size > 0 GROUP BY source, size),
        a AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
                     sum(words::HUGEINT * m) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM k),
        b AS (SELECT t.source, max_by(c, size) AS c FROM (SELECT a.*, (target - before * 2) / open::DOUBLE AS c, t.source AS src FROM a JOIN t ON a.source IS NOT DISTINCT FROM t.source) x JOIN t ON x.src IS NOT DISTINCT FROM t.source
              WHERE c * m <= 2 AND c >= 0 GROUP BY t.source),
        z AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, u, CASE WHEN d.size = 0 THEN 0.0 ELSE least(coalesce(c * floor(sqrt(d.size::DOUBLE) * {MEASURE})::BIGINT, 2.0), 2.0) END::DOUBLE AS want
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source),
        r0 AS (SELECT doc_id, source, size, source_size, target, floor(want)::BIGINT AS whole, want - floor(want) AS p, (u / (1 - u)) / CASE WHEN want > floor(want) THEN (want - floor(want)) / (1 - (want - floor(want))) END AS rank, FALSE AS taken FROM z),"""
    + ",".join(_round(k, k == ROUNDS - 1) for k in range(ROUNDS))
    + f"""
        SELECT doc_id, size, source_size, target, size * (whole + taken::BIGINT) AS taken, source, whole + taken::BIGINT AS copies FROM r{ROUNDS}"""
}
