"""Token ids of whole corpora in compressed, checksummed files.

Layout: a folder of Parquet files with one row per block. Parts follow each other in document
order, blocks within a part too; a block holds at most ``block_ids`` ids and is coded on its own
(``range_coder``), so any block can be read without the others. Columns: part, block, n_ids,
crc32 (of the ids as little-endian unsigned 32-bit integers), first_id (number, within the part, of
the first id, so that readers need not know the size of blocks), first_doc (number, within the
part, of the document of the first id), doc_ids and doc_begins (documents that begin in this
block and the place of their first id), payload.

Documents are ordered by doc_id, NULL first, and by a digest of the text where ids repeat; one
doc_id with very many rows is split over parts by that digest. NULL text is empty: such a
document has the end id only. An empty table gives an empty folder of files and no rows. Only
the id and text columns are read. A block whose checksum does not hold ends the read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.bpe import PieceIds, text_ids
from revlens.llm.frames import batch_of, chunks
from revlens.llm.range_coder import decode_blocks, encode_blocks

BLOCK_IDS = 4096
LANES = 1024  # blocks coded in step, of about 90 KB each with their model
BLOCKS = (
    "part int, block bigint, n_ids int, crc32 bigint, first_id bigint, first_doc bigint, "
    "doc_ids array<bigint>, doc_begins array<int>, payload binary"
)
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
_NAMES = ["part", "block", "n_ids", "crc32", "first_id", "first_doc", "doc_ids", "doc_begins", "payload"]


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _by_library(path: str):
    """The library itself encodes every distinct segment."""

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in _library(path).encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter((i for x in found for i in x), np.int64, int(sizes.sum()))
        return ids, sizes

    return encode


def _blocks(part: int, numbered: Iterator[tuple[list, np.ndarray, np.ndarray]], block_ids: int) -> Iterator[pa.RecordBatch]:
    """Block rows from (doc ids, ids, n + 1 positions) of successive documents."""
    kept = np.zeros(0, np.int64)
    begins: list[tuple[int, int | None]] = []  # (place within kept, doc id)
    block = docs_before = ids_before = 0

    def rows(count: int, size: int) -> pa.RecordBatch:
        nonlocal kept, begins, block, docs_before, ids_before
        pieces = [kept[k * size : (k + 1) * size] for k in range(count)]
        places = np.array([p for p, _ in begins], np.int64)
        edges = np.searchsorted(places, np.arange(count + 1) * size)
        data = [[part] * count, range(block, block + count), [len(p) for p in pieces]]
        data.append([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces])
        data.append((np.arange(count) * size + ids_before).tolist())
        opens = edges[:-1] + (np.append(places, -1)[edges[:-1]] != np.arange(count) * size) * -1
        data.append((opens + docs_before).tolist())
        data.append([[d for _, d in begins[a:b]] for a, b in zip(edges[:-1], edges[1:])])
        data.append([[p - k * size for p, _ in begins[a:b]] for k, (a, b) in enumerate(zip(edges[:-1], edges[1:]))])
        data.append(encode_blocks(pieces))
        used = count * size
        docs_before += int(edges[-1])
        ids_before += used
        begins = [(p - used, d) for p, d in begins[int(edges[-1]) :]]
        kept, block = kept[used:], block + count
        return batch_of(_NAMES, data, _KINDS)

    for doc_ids, ids, bounds in numbered:
        begins.extend(zip((bounds[:-1] + len(kept)).tolist(), doc_ids))
        kept = np.concatenate([kept, ids])
        while len(kept) >= LANES * block_ids:
            yield rows(LANES, block_ids)
    full = len(kept) // block_ids
    if full:
        yield rows(full, block_ids)
    if len(kept):
        yield rows(1, len(kept))


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Encode every text, append ``end_id``, and write the blocks (one job and a sampling one).

    An id that the coder cannot hold (over 65,535) ends the job.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceIds(_by_library(tokenizer))

        def numbered():
            for batch in chunks(batches, 1):
                ids, bounds = text_ids(pieces, batch.column(1), keep_space=False)
                ended = np.insert(ids.astype(np.int64), bounds[1:], end_id)
                yield batch.column(0).to_pylist(), ended, bounds + np.arange(len(bounds))

        yield from _blocks(TaskContext.get().partitionId(), numbered(), block_ids)

    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys, "text")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(part, block, first_id, first_doc, doc_ids, doc_begins, ids): the blocks decoded and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                piece = batch.slice(at, LANES)
                sums = piece.column(3).to_pylist()
                found = [x.astype("<u4").tobytes() for x in decode_blocks(piece.column(8).to_pylist(), piece.column(2).to_pylist())]
                for ids, expected in zip(found, sums):
                    if zlib.crc32(ids) != expected:
                        raise ValueError(f"a block in {folder} does not match its checksum")
                columns = [piece.column(i) for i in (0, 1, 4, 5, 6, 7)] + [pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "first_id", "first_doc", "doc_ids", "doc_begins", "ids"])

    schema = "part int, block bigint, first_id bigint, first_doc bigint, doc_ids array<bigint>, doc_begins array<int>, ids binary"
    return spark.read.schema(BLOCKS).parquet(folder).mapInArrow(run, schema)


def fragments(blocks: DataFrame) -> DataFrame:
    """(part, doc, block, doc_id, begins, place, position, ids): the ids that each document has in each block."""
    spans = F.expr(
        """transform(
             if(size(doc_begins) = 0 or doc_begins[0] > 0,
                array_insert(cast(doc_begins as array<bigint>), 1, cast(0 as bigint)),
                cast(doc_begins as array<bigint>)),
             (b, i) -> named_struct('b', b, 'i', i))"""
    )
    cut = blocks.withColumn("spans", spans).withColumn("carried", F.expr("size(spans) > size(doc_begins)"))
    cut = cut.withColumn("ends", F.expr("transform(spans, (s, i) -> coalesce(get(spans, i + 1).b, octet_length(ids) div 4))"))
    one = cut.select("part", "block", "first_id", "first_doc", "carried", "doc_ids", "ids", "ends", F.explode("spans").alias("s"))
    return one.select(
        "part",
        (F.col("first_doc") + F.col("s.i")).alias("doc"),
        "block",
        F.expr("get(doc_ids, s.i - if(carried, 1, 0))").alias("doc_id"),
        F.expr("not (carried and s.i = 0)").alias("begins"),
        F.col("s.b").alias("place"),
        (F.col("first_id") + F.col("s.b")).alias("position"),
        F.expr("substring(ids, cast(4 * s.b + 1 as int), cast(4 * (ends[s.i] - s.b) as int))").alias("ids"),
    )


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """The product of two remainders modulo the checksum's polynomial, bits reversed."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return product


@lru_cache(maxsize=65536)
def _shift(n_bytes: int) -> int:
    """x to the power of 8 * n_bytes."""
    result, square = 1 << 31, 1 << 23
    while n_bytes:
        if n_bytes & 1:
            result = _times(result, square)
        square, n_bytes = _times(square, square), n_bytes >> 1
    return result


def join_checksums(sums: list[tuple[int, int]]) -> int:
    """The crc32 of successive pieces from each one's (crc32, bytes)."""
    total = 0
    for value, size in sums:
        total = _times(_shift(size), total) ^ value
    return total


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    Only checksums of fragments are shuffled, never ids. start counts the ids of all documents
    before; it needs one number per part, summed over the parts.
    """
    own = fragments(read(spark, folder)).select(
        "part", "doc", "block", "doc_id", "begins", "position", (F.octet_length("ids") / 4).cast("bigint").alias("n"), F.crc32("ids").alias("crc")
    )
    joined = own.groupBy("part", "doc").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("position").alias("start"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "crc", "n"))).alias("pieces"),
    )
    totals = spark.read.schema(BLOCKS).parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("held"))
    before = totals.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [join_checksums([(p["crc"], 4 * p["n"]) for p in pieces]) for pieces in batch.column(3).to_pylist()]
            yield batch_of(["doc_id", "start", "n_tokens", "ids_crc32"], [batch.column(0), batch.column(1), batch.column(2), sums], [pa.int64()] * 4)

    whole = joined.join(F.broadcast(before), "part")  # one row for each file
    return whole.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "pieces").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
