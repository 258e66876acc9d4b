"""Spark-first analytics engine for posting-style corpora."""

from __future__ import annotations

import os
import tempfile
import zipfile

BATCH_ROWS = 1000

_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the Python workers of spark's application, once, and bound the batches that they get.

    A batch of the default 10,000 long texts takes tens of MB in the JVM, and
    again in the worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="siltstone-"), "siltstone.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
