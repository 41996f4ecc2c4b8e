"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

RELEASE_SECONDS = 10  # at least, from one collection of the driver's garbage to the next
_LEFT: list[tuple[SparkSession, str]] = []
_released = time.monotonic()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="revlens-llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete_left() -> None:
    while _LEFT:
        spark, folder = _LEFT.pop()
        try:
            _delete(spark, folder)
        except Exception:  # the session has ended; its cluster cleans the folder up
            return


def _release(spark: SparkSession) -> None:
    """Let the driver collect its garbage: only then does Spark remove shuffle files and broadcasts
    of finished steps, and the plans and figures of a long chain of steps pile up until the heap is full."""
    global _released
    if time.monotonic() - _released >= RELEASE_SECONDS:
        gc.collect()
        spark._jvm.java.lang.System.gc()
        _released = time.monotonic()


class Workspace:
    """Stored tables of one operator call: lineage ends at each, so a lost executor costs no
    recomputation of what is before it. ``drop`` removes what later steps don't need, and now and
    then the driver's garbage; the rest, which the returned DataFrame may still read, goes when
    Python ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        if not _LEFT:
            atexit.register(_delete_left)
        _LEFT.append((spark, self.folder))

    def path(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def put(self, df: DataFrame) -> DataFrame:
        """Compute ``df`` once (one job) and read it back."""
        path = self.path()
        df.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        for df in stored:
            _delete(self.spark, self._paths.pop(id(df)))
        _release(self.spark)
