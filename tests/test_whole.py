"""Outputs are whole or absent."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.sources import csv, jsonl, whole


@pytest.fixture
def failing(spark):
    """Thousand rows in eight tasks, the last of which fails after others have written."""
    bad = F.raise_error(F.lit("lost")).cast("bigint")
    return spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 990, F.col("id")).otherwise(bad).alias("id"))


def left(folder):
    return sorted(os.listdir(folder))


def test_a_failed_job_leaves_what_was_there(spark, tmp_path, failing):
    path = str(tmp_path / "out")
    csv.write_csv(spark.range(5), path)
    with pytest.raises(PySparkException):
        csv.write_csv(failing, path)
    assert left(tmp_path) == ["out"]
    assert csv.read_csv(spark, path, spark.range(1).schema).count() == 5
    with pytest.raises(PySparkException):
        jsonl.write_jsonl(failing, str(tmp_path / "other"))
    assert left(tmp_path) == ["out"]


def test_overwrite_replaces_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "a b" / "out")
    csv.write_csv(spark.range(100), path)
    csv.write_csv(spark.range(7), path, order_by=["id"], one_file=True)
    assert [r.id for r in csv.read_csv(spark, path, spark.range(1).schema).collect()] == list(range(7))
    assert left(tmp_path / "a b") == ["out"]
    csv.write_csv(spark.range(0), path)
    assert csv.read_csv(spark, path, spark.range(1).schema).count() == 0


def test_one_of_several_writers_wins(spark, tmp_path):
    path = str(tmp_path / "out")

    def attempt(k):
        try:
            jsonl.write_jsonl(spark.range(10 * (k + 1)), path)
            return 10 * (k + 1)
        except FileExistsError:
            return None

    with ThreadPoolExecutor(4) as pool:
        results = [r for r in pool.map(attempt, range(4)) if r]
    assert len(results) == 1 and spark.read.json(path).count() == results[0]
    assert left(tmp_path) == ["out"]
    with pytest.raises(FileExistsError):
        jsonl.write_lines(spark.createDataFrame([("x",)], "value string"), path)


def test_what_is_not_whole_is_not_put_in_place(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(whole.Incomplete):
        whole.put_whole(spark.range(9), path, lambda df, place: df.write.parquet(place), lambda s, place: s.read.parquet(place).limit(8))
    assert left(tmp_path) == []
    with pytest.raises(ValueError):
        whole.put_whole(spark.range(9), path, None, None, mode="append")


def test_a_rename_that_fails_brings_the_old_output_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    csv.write_csv(spark.range(5), path)
    rename = whole._Files.rename

    def broken(self, old, new):
        if ".new-" in old:
            raise OSError("lost")
        rename(self, old, new)

    monkeypatch.setattr(whole._Files, "rename", broken)
    with pytest.raises(OSError):
        csv.write_csv(spark.range(9), path)
    assert left(tmp_path) == ["out"] and spark.read.option("header", True).csv(path).count() == 5


@pytest.mark.parametrize("rows", [[("a\nb",), ('q"uo,te',), (None,), ("",), (" ",)], [(None, None), ("x\r\ny", "\n"), ("", None)], []])
def test_rows_that_csv_hides_or_spreads_over_lines(spark, tmp_path, rows):
    width = len(rows[0]) if rows else 2
    table = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(width)))
    csv.write_csv(table, str(tmp_path / "out"))
    assert left(tmp_path) == ["out"]
