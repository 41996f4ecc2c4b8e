"""Small helpers for reading tables and for Arrow functions inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def batch_of(names: list[str], columns: list, kinds: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)
