"""Encoding, files and counts against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from revlens.llm import bpe, range_coder, token_counts, token_files
from revlens.llm.store import Workspace

PARTS = ["a", "b", " ", "  ", "\n", "\n\n", "the", " THE", "'s", "'", "<|endoftext|>", " ", "　", "\x1c", "\x0b", "\t", "é", "漢", "1", "23", "!", "́"]
PARTS += ["😀", "\x00", "aaaaaaaa", " ", "ſ", "_", "<unk>", "<0x41>", "<s>", "▁", "word,", "End.", "x.y"]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    made = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 14)))) for i in range(1500)]
    return [*made, (2000, None), (2001, ""), (2002, "a" * 20_000), (2003, "word " * 5000), (2003, "word " * 5000)]


def test_bpe_equals_the_library(docs_of, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected.append((doc, len(ids), packed, hashlib.sha256(decoded).hexdigest()))
    got = bpe.digests(bpe.decode(bpe.encode(docs_of(rows), path), path)).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sorted(map(tuple, bpe.round_trip(docs_of(rows), path).collect())) == sorted(expected)
    assert bpe.round_trip(docs_of([]), path).count() == 0
    assert bpe.encode(docs_of([]), path).count() == 0
    assert bpe.encode(docs_of([(None, "a")]), path).first().doc_id is None


def test_unknown_ids_decode_to_nothing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = spark.createDataFrame([(1, struct.pack("<3I", 64, 4_000_000, 65)), (2, None)], "doc_id bigint, ids binary")
    assert sorted(r.text for r in bpe.decode(frame, path).collect()) == ["", "ab"]


@pytest.mark.parametrize("block_ids", [64, 1024])
def test_files_read_back_as_the_library_encodes(spark, docs_of, rows, block_ids):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected, start = [], 0
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    folder = Workspace(spark).path()
    token_files.write(docs_of(rows).repartition(5), folder, path, 1, block_ids=block_ids)
    assert sorted(map(tuple, token_files.documents(spark, folder).collect())) == expected
    pieces = token_files.fragments(token_files.read(spark, folder)).collect()
    joined = b"".join(p.ids for p in sorted(pieces, key=lambda p: (p.part, p.block, p.place)))
    assert len(joined) == 4 * start
    empty = Workspace(spark).path()
    token_files.write(docs_of([]), empty, path, 1)
    assert token_files.documents(spark, empty).count() == 0


def test_blocks_are_independent_and_exact():
    r = np.random.default_rng(1)
    blocks = [(r.zipf(1.3, int(n)) % 49_408).astype(np.int64) for n in r.integers(0, 600, 40)]
    blocks += [np.zeros(600, np.int64), np.arange(600) % 7, np.full(600, 65_535), np.zeros(0, np.int64)]
    payloads = range_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(payloads, [len(b) for b in blocks])))
    assert range_coder.encode_blocks(blocks[3:4]) == payloads[3:4]
    assert sum(map(len, payloads)) < 2 * sum(map(len, blocks))


def test_ids_over_the_limit_are_refused():
    for bad in (65_536, -1):
        with pytest.raises(ValueError, match="65535"):
            range_coder.encode_blocks([np.array([1, bad, 2])])


def test_the_three_orders_are_mixed():
    """Ids that follow from the previous one, or from the previous two, or are few, cost little."""
    r = np.random.default_rng(3)
    few = r.integers(0, 4, 1000) * 9173
    cycle = np.tile(r.integers(0, 49_408, 50), 20)
    pairs = [7, 9]
    for _ in range(998):
        pairs.append(int(pairs[-1] * 31 + pairs[-2] * 17) % 12 * 4001)
    noise = r.integers(0, 49_408, 1000)
    sizes = [len(p) / 1000 for p in range_coder.encode_blocks([few, cycle, np.array(pairs), noise])]
    assert sizes[0] < 0.5 and sizes[1] < 0.6 and sizes[2] < 0.4 and sizes[3] < 2.3


def test_full_counts_are_halved():
    block = np.repeat([5, 6, 5], [2000, 900, 300])
    payload = range_coder.encode_blocks([block, block[:10]])
    assert all((a == b).all() for a, b in zip(range_coder.decode_blocks(payload, [len(block), 10]), [block, block[:10]]))


def test_checksums_join():
    data = random.Random(2).randbytes(5000)
    cuts = [0, 0, 7, 4096, 5000]
    assert token_files.join_checksums([(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]) == zlib.crc32(data)


def test_counts_equal_the_library(docs_of, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = Tokenizer(models.Unigram(token_counts.pieces(path), 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    plain = [*rows, (3000, "▁hello"), (3001, "a ▁ b"), (3002, "▁"), (3003, "▁▁x ▁"), (3004, " ▁"), (3005, "a▁b▁")]
    got = sorted((r.doc_id, r.n_tokens) for r in token_counts.count(docs_of(plain), path).collect())
    assert got == sorted((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in plain)
    assert token_counts.count(docs_of([]), path).count() == 0


def test_tables_and_blocks_without_one():
    r = np.random.default_rng(7)
    often = [r.zipf(1.2, 5000) % 65_536, r.integers(0, 3, 70_000), np.repeat([65_535, 0], [1, 4999]), r.integers(0, 30_000, 4096), np.array([9]), np.array([9, 9])]
    for block, listed in zip(often, (True, False, True, False, False, True)):
        table = range_coder._table(block)
        ids, used = range_coder._read_table(table + b"rest", len(block))
        assert used == len(table)
        assert (ids is not None) == listed and (ids is None or np.array_equal(ids, np.sort(block)))
    payloads = range_coder.encode_blocks(often)
    back = range_coder.decode_blocks(payloads, [len(b) for b in often])
    assert all(np.array_equal(a, b) for a, b in zip(often, back))
    assert range_coder.encode_blocks(often[::-1]) == payloads[::-1]
