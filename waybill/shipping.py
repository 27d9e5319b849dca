"""Makes the package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Hand the package to Spark as a zip of its sources, once an application.

    Spark serves the file from the driver, so executors need neither this
    repository nor a shared folder.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None or (app := spark.sparkContext.applicationId) in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="waybill-"), "waybill_sources.zip"))
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, os.path.join(here.name, p.relative_to(here)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
