"""Prepare a session for this package's Python tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


BATCH_ROWS, BATCH_BYTES = "2000", "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors' workers, where it isn't installed, and keep Arrow batches small.

    Once per application what ``spark-submit --py-files`` does for a started session. The default
    batch of 10,000 rows holds too many long texts at once for a worker with little memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if not getattr(context, "_has_revlens", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="revlens-zip-"), "revlens.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(package)))
        context.addPyFile(archive)
        context._has_revlens = True
    return spark
