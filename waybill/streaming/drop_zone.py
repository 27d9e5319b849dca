"""A drop zone as a stream: new page files are parsed and matched batch by batch.

The batch engine has no streams; this is an addition. Matching is stateless
against the master, so each micro-batch is an ordinary run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.match import match_invoices
from ..operators.pages import page_ship_to
from ..plans.vendors import VendorSpec
from ..sources.readers import PAGES


def parsed_stream(spark: SparkSession, folder: str, spec: VendorSpec, max_files: int = 100) -> DataFrame:
    """Fields of pages as their parquet files arrive in ``folder``."""
    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files).parquet(folder)
    return spec.parse(pages.filter(pages.vendor == spec.key))


def start(spark: SparkSession, folder: str, master: DataFrame, spec: VendorSpec, sink: Callable[[DataFrame, int], None], checkpoint: str, deny_names: list[str] | None = None, available_now: bool = False):
    """Match every batch of new pages and hand it to ``sink(matches, epoch)``; progress is kept in ``checkpoint``."""

    def each(batch: DataFrame, epoch: int) -> None:
        sink(match_invoices(page_ship_to(batch), master, deny_names), epoch)

    writer = parsed_stream(spark, folder, spec).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
