"""Byte-level BPE by a pair occurrence index, and the way back from ids to texts.

A task cuts its texts into pieces, takes every distinct piece once, and lays the pieces' bytes
out in one array of symbols. An index maps each mergeable pair to all its positions there. The
ranks that occur are applied in ascending order, each to all its positions at once, and only the
lists of the pairs next to a merge are updated. Ids of whole texts are put together from the ids
of their pieces. The tokenizer file is read in each task from the path given; the pieces already
encoded by a task are kept up to a bound, beyond which they are encoded again.

Empty or NULL text: no ids, and it decodes to the empty text. Ids outside of the vocabulary
decode to nothing. Rows that repeat are encoded like any other; only the id and text columns
are read, so extra columns never clash.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of, chunks
from revlens.llm.strings import Known, ranges, segments, utf8

# Fixed value: the pattern that byte-level BPE vocabularies cut texts with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_IDS = 3_000_000
CHUNK_BYTES = 4 << 20


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins that vocabulary files write for bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _sorted_distinct(parts: list[np.ndarray]) -> np.ndarray:
    joined = np.sort(np.concatenate(parts))
    return joined[np.append(True, joined[1:] != joined[:-1])] if len(joined) > 1 else joined


class Vocabulary:
    """Merges, ids and special tokens of a tokenizer file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        to_byte = byte_of_character()
        model = content["model"]
        tokens = {t: bytes(to_byte[c] for c in t) for t in model["vocab"]}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        bytes_of = {i: tokens[t] for t, i in model["vocab"].items()}
        bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.size = max(bytes_of) + 1
        self.byte_ids = np.zeros(256, np.int64)
        for token, value in tokens.items():
            if len(value) == 1:
                self.byte_ids[value[0]] = model["vocab"][token]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = model["vocab"]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        self.rank_order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.rank_order]
        self.pieces = regex.compile(PATTERN)
        parts = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(parts) + ")") if parts else None
        sizes = np.array([len(bytes_of.get(i, b"")) for i in range(self.size)], np.int64)
        self.token_sizes = np.append(sizes, 0)
        self.token_starts = np.append(np.cumsum(sizes) - sizes, 0)
        self.token_bytes = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(self.size)), np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it never merges."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.rank_order[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbols)
        ends = np.cumsum(sizes)
        following, previous = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = sizes > 0
        following[ends[filled] - 1] = -1
        previous[(ends - sizes)[filled]] = -1
        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Add positions to the lists of the pairs that begin there."""
            ranks = self.ranks(symbols[positions], symbols[following[positions]])
            mergeable = ranks >= 0
            positions, ranks = positions[mergeable], ranks[mergeable]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            edges = np.flatnonzero(np.diff(ranks)) + 1
            for rank, group in zip(ranks[np.append(0, edges)].tolist(), np.split(positions, edges)):
                if rank not in lists:
                    lists[rank] = []
                    heapq.heappush(active, rank)
                lists[rank].append(group)

        note(np.flatnonzero(following >= 0))
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.left[rank], self.right[rank], self.merged[rank]
            held = lists.pop(rank)
            found = held[0] if len(held) == 1 else _sorted_distinct(held)
            found = found[(symbols[found] == a) & (following[found] >= 0)]
            found = found[symbols[following[found]] == b]
            if a == b:  # of overlapping pairs the left one goes first
                taken, last = [], -1
                for p in found.tolist():
                    if p != last:
                        taken.append(p)
                        last = following[p]
                found = np.array(taken, np.int64)
            if not len(found):
                continue
            second = following[found]
            beyond = following[second]
            symbols[found], symbols[second] = new, -1
            following[found] = beyond
            inner = beyond >= 0
            previous[beyond[inner]] = found[inner]
            before = previous[found]
            note(_sorted_distinct([found[inner], before[before >= 0]]))
        alive = symbols >= 0
        counts = np.append(0, np.cumsum(alive))
        return symbols[alive], counts[ends] - counts[ends - sizes]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PieceIds:
    """Ids of distinct segments by their hash, kept up to ``KEPT_IDS`` ids."""

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known = Known()
        self.starts = np.zeros(1, np.int64)  # of each segment's ids, and the end of the last
        self.ids = np.zeros(0, np.int32)

    def of(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments in order, how many each has)."""
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > KEPT_IDS:
            self.clear()
        number = self.known.find(distinct)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            at, data = first[missing], raw.tobytes()
            texts = [data[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())]
            ids, sizes = self.encode(texts)
            number[missing] = self.known.add(distinct[missing])
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes))
            self.ids = np.append(self.ids, ids.astype(np.int32))
        number = number[inverse]
        sizes = self.starts[number + 1] - self.starts[number]
        return self.ids[ranges(self.starts[number], sizes)], sizes


def text_ids(pieces: PieceIds, column: pa.Array, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, n + 1 positions of the rows in them)."""
    raw, offsets = utf8(column)
    found = list(segments(raw, offsets, keep_space))
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    begin, end, hashes = (np.concatenate(x) for x in zip(*found))
    ids, sizes = pieces.of(raw, begin, end, hashes)
    total = np.append(0, np.cumsum(sizes))
    return ids, total[np.searchsorted(begin, offsets)]


def _byte_level(words: Vocabulary):
    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        slot: dict[str, int] = {}
        order, counts = [], []
        for text in texts:
            marked = any(name in text for name in words.special)
            parts = words.specials.split(text) if marked else (text,)
            mine = []
            for part in parts:
                if part in words.special:
                    mine.append(-1 - words.special[part])
                else:
                    mine.extend(slot.setdefault(p, len(slot)) for p in words.pieces.findall(part))
            order.extend(mine)
            counts.append(len(mine))
        ids, sizes = words.merge([p.encode() for p in slot])
        base = len(slot)
        extra = np.array(sorted(words.special.values()), np.int64)
        ids = np.append(ids, extra)
        starts = np.append(np.cumsum(sizes) - sizes, np.arange(len(extra)) + sizes.sum())
        sizes = np.append(sizes, np.ones(len(extra), np.int64))
        at = np.array(order, np.int64)
        at = np.where(at < 0, base + np.searchsorted(extra, -1 - at), at)
        lengths = sizes[at] if len(at) else np.zeros(0, np.int64)
        total = np.append(0, np.cumsum(lengths))
        ends = np.cumsum(np.array(counts, np.int64))
        return ids[ranges(starts[at], lengths)] if len(at) else ids[:0], np.diff(total[np.append(0, ends)])

    return encode


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids): ids are the text's token ids as little-endian unsigned 32-bit integers.

    ``path`` names the tokenizer file, at the same place on every executor. Special tokens
    inside a text get their id.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceIds(_byte_level(vocabulary(path)))
        for batch in chunks(batches, 1, CHUNK_BYTES):
            ids, bounds = text_ids(pieces, batch.column(1), keep_space=True)
            data = ids.astype("<u4").tobytes()
            cut = [data[a:b] for a, b in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist())]
            yield batch_of(["doc_id", "ids"], [batch.column(0), cut], [pa.int64(), pa.binary()])

    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def _decoded(words: Vocabulary, ids: np.ndarray) -> str:
    ids = np.minimum(ids.astype(np.int64), words.size)
    return words.token_bytes[ranges(words.token_starts[ids], words.token_sizes[ids])].tobytes().decode("utf-8", "replace")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids): special tokens are written out, broken bytes replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [_decoded(words, np.frombuffer(value or b"", "<u4")) for value in batch.column(1).to_pylist()]
            yield batch_of(["doc_id", "ids", "text"], [batch.column(0), batch.column(1), texts], [pa.int64(), pa.binary(), pa.string()])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """What ``digests(decode(encode(docs)))`` gives, in one pass of one worker per task.

    Neither ids nor decoded texts leave the task, and there is one vocabulary in it.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        pieces = PieceIds(_byte_level(words))
        for batch in chunks(batches, 1, CHUNK_BYTES):
            ids, bounds = text_ids(pieces, batch.column(1), keep_space=True)
            out = [[], [], []]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                mine = ids[a:b]
                out[0].append(b - a)
                out[1].append(sha256(mine.astype("<u4").tobytes()).hexdigest())
                out[2].append(sha256(_decoded(words, mine).encode()).hexdigest())
            yield batch_of(["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [batch.column(0), *out], [pa.int64(), pa.int64(), pa.string(), pa.string()])

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def digests(decoded: DataFrame) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )
