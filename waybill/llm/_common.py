"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    One is set here only where the session has none and runs in one process, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="waybill-ckpt-"))
    return context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def python_ready(spark: SparkSession, rows: int = 1024) -> None:
    """Before Python workers run: hold Arrow batches to so many rows, which bounds what a worker has at once, and hand them the package."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def few(df: DataFrame, limit: int) -> bool:
    """Whether a (checkpointed) frame has at most ``limit`` rows."""
    return df.limit(limit + 1).count() <= limit


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column, limit: int = 1_000_000, parts: int = 100_000) -> DataFrame:
    """``rows`` with the columns of their group in ``groups`` (checkpointed, one row a ``key``; null without one), no large group's rows moved.

    At most ``limit`` groups are broadcast. Of more, those that hold over 1 /
    ``parts`` of all grouped rows (by ``size``) are, which are fewer than
    ``parts``; the rest are joined by a shuffle, where rows that have their group
    or no key go by ``spread``.
    """
    if few(groups, limit):
        return rows.join(F.broadcast(groups), key, "left")
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) > total / parts
    others = [c for c in groups.columns if c != key]
    both = F.struct(*others)
    rows = rows.join(F.broadcast(groups.filter(large).select(key, both.alias("__wb_hot"))), key, "left")
    own = F.col(key) if dict(rows.dtypes)[key] != "binary" else F.hex(key)
    seek = F.when(F.col("__wb_hot").isNull() & F.col(key).isNotNull(), own.cast("string")).otherwise(F.concat(F.lit("-"), spread))
    cold = groups.filter(~large).select(own.cast("string").alias("__wb_key"), both.alias("__wb_cold"))
    rows = rows.withColumn("__wb_seek", seek).join(cold, F.col("__wb_seek") == F.col("__wb_key"), "left")
    rows = rows.withColumn("__wb_group", F.coalesce("__wb_hot", "__wb_cold"))
    return rows.select(*[c for c in rows.columns if not c.startswith("__wb_") and c not in others], *[F.col(f"__wb_group.`{c}`").alias(c) for c in others])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(docs: DataFrame, text_col: str, chunk_mb: int = 4) -> int:
    """How many chunks of about ``chunk_mb`` MB the texts make, at least two for each shuffle partition."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(2 * partitions(docs.sparkSession), math.ceil(size / (chunk_mb << 20)))


def hashable(df: DataFrame, names: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in names if "map<" not in kinds[c] and "variant" not in kinds[c]]


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names the result is about to use."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
