"""Outputs that are whole or absent: written beside their place, checked, and renamed into it.

A job that fails, at whatever point, leaves what was there before. Renaming is one step of the
file system (HDFS, local disks); stores that copy in order to rename, such as most object stores,
give up that guarantee, and ``errorifexists`` is then only as good as the store's own check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# How a table is written to a path, and how that path is read back.
Writer = Callable[[DataFrame, str], None]
Reader = Callable[[SparkSession, str], DataFrame]


class Incomplete(RuntimeError):
    """What was read back is not what was written; nothing was put in place."""


class _Files:
    """Hadoop's file operations on paths of any file system it knows."""

    def __init__(self, spark: SparkSession, path: str):
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._path = hadoop.Path
        given = hadoop.Path(path.rstrip("/"))
        self._fs = given.getFileSystem(conf)
        self._context = hadoop.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        self.target = self._fs.makeQualified(given).toString()

    def beside(self, kind: str) -> str:
        """A new hidden name in the same folder, which readers of the folder skip."""
        place = self._path(self.target)
        return self._path(place.getParent(), f"_{place.getName()}.{kind}-{uuid.uuid4().hex}").toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, path: str, new: str) -> None:
        """Fails if ``new`` is there."""
        self._context.rename(self._path(path), self._path(new), self._no_overwrite)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def put_whole(
    df: DataFrame, path: str, write: Writer, read: Reader, mode: str = "overwrite", seen: Column | None = None
) -> int:
    """Write ``df`` so that ``path`` holds all of it or what it held before; the number of rows (starts jobs).

    The rows are counted as they are written, and again as they are read back with ``read``; only
    those where ``seen`` is not NULL, if the format shows no others. With ``errorifexists`` the first of several writers wins and the others fail; with ``overwrite`` the
    last one does, and an earlier output is moved away, and deleted, only once the new one is whole.
    """
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    files = _Files(spark, path)
    if mode == "errorifexists" and files.exists(files.target):
        raise FileExistsError(path)
    staged, counting = files.beside("new"), Observation()
    try:
        write(df.observe(counting, F.count(F.lit(1) if seen is None else seen).alias("n")), staged)
        written, found = counting.get.get("n", 0), read(spark, staged).count()
        if written != found:
            raise Incomplete(f"{written} rows were written for {path}, but {found} are there")
        _into_place(files, staged, path, mode)
    finally:
        files.remove(staged)
    return written


def _into_place(files: _Files, staged: str, path: str, mode: str) -> None:
    old = files.beside("old")
    if mode == "overwrite" and files.exists(files.target):
        files.rename(files.target, old)
    try:
        files.rename(staged, files.target)
    except Exception as error:
        if files.exists(old) and not files.exists(files.target):
            files.rename(old, files.target)
        if mode == "errorifexists" and files.exists(files.target):
            raise FileExistsError(path) from error
        raise
    finally:
        files.remove(old)
