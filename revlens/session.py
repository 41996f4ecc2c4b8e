"""Session settings the library relies on, and stored tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


_STORED: list[tuple[SparkSession, str]] = []


def build_session(app_name: str = "revlens", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are written for.

    Cluster sizing (executors, memory, ``spark.sql.shuffle.partitions``) is left to
    ``spark-submit`` or to ``conf``; adaptive execution merges small partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Hash instead of sort the long side of a join whose other side is small per task.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for data shared by all executors.

    A local session without one gets a folder of its own, which it keeps.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="revlens-"))
        return shared_folder(spark)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def materialise(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder (starts a job).

    With ``partition_by`` rows that differ there are stored apart, and a filter reads its part only.

    Used for tables that several later steps read and that are much smaller than the
    reviews. The lineage ends here, so a lost executor costs no recomputation of it.
    The table is there until ``remove_stored`` or the end of Python.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/revlens-{uuid.uuid4().hex}"
    if not _STORED:
        atexit.register(remove_stored)
    _STORED.append((spark, folder))
    df.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def remove_stored() -> None:
    """Delete all tables that ``materialise`` has stored; results built on them end here."""
    while _STORED:
        spark, folder = _STORED.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session's JVM is gone; its cluster cleans the folder up
            _STORED.clear()
