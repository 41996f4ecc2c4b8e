"""Smaller JSON-lines files for dry runs, cut from large ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from revlens.operators.sampling import sample_repeated
from revlens.sources.jsonl import PLACE, head_lines, read_lines, write_lines


def save_first_lines(spark: SparkSession, path: str, out: str, n: int = 5000) -> None:
    """Write the first ``n`` lines of a file (starts a job)."""
    write_lines(head_lines(spark, path, n), out)


def save_random_lines(
    spark: SparkSession, path: str | list[str], out: str, n: int = 50_000, seed: int = 42
) -> None:
    """Write exactly ``n`` random lines in the order of the input (starts jobs)."""
    write_lines(sample_repeated(read_lines(spark, path), n, PLACE, seed).orderBy("file", *PLACE), out)
