"""Words and segments of Arrow text columns, found and hashed with numpy over whole buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = np.arange(256)
_FOLDED[65:91] += 32
FOLDED_VALUES = BYTE_VALUES[_FOLDED]

# The white space of the word pattern.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, WINDOW + 1)
            inverse = pow(int(_BASE), -1, 1 << 64)
            self.up, self.down = (self._powers(b, size) for b in (int(_BASE), inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, np.uint64(base & _MASK))
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS = _Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and the n + 1 offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def prefix_hashes(raw: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, down): the hash of bytes [s, e) is (sums[e] - sums[s]) * down[s]."""
    up, down = _POWERS.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=sums[1:])
    return sums, down


def windows(raw: np.ndarray, is_cut) -> Iterator[tuple[int, int]]:
    """Ranges of about ``WINDOW`` bytes that end where ``is_cut(position)`` allows it.

    ``is_cut`` takes a range (a, b) and returns a mask of the positions where a range may begin.
    """
    begin, total = 0, len(raw)
    while begin < total:
        end = min(begin + WINDOW, total)
        while end < total:
            allowed = np.flatnonzero(is_cut(begin + 1, end + 1))
            if len(allowed):
                end = begin + 1 + int(allowed[-1])
                break
            end = min(end + WINDOW, total)
        yield begin, end
        begin = end


def word_hashes(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, n + 1 positions of the rows in them); words never cross rows."""
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    hashes, starts = [], []

    def is_cut(a: int, b: int) -> np.ndarray:
        return SPACE[raw[a - 1 : b - 1]] | first[a:b]

    for a, b in windows(raw, is_cut):
        piece = raw[a:b]
        blank = SPACE[piece]
        begins = ~blank
        begins[1:] &= blank[:-1] | first[a + 1 : b]
        ends = ~blank
        ends[:-1] &= blank[1:] | first[a + 1 : b]
        s = np.flatnonzero(begins)
        sums, down = prefix_hashes(piece, values)
        hashes.append(mix((sums[np.flatnonzero(ends) + 1] - sums[s]) * down[s]))
        starts.append(s + a)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; of fewer words, the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words
    length = min(size, n)
    total = np.full(n - length + 1, _PLACE[length], np.uint64)
    for j in range(length):
        total += words[j : n - length + 1 + j] * _PLACE[j]
    return mix(total)


def text_shingles(column: pa.Array, size: int, values: np.ndarray = FOLDED_VALUES) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes; A-Z count as a-z."""
    raw, offsets = utf8(column)
    words, bounds = word_hashes(raw, offsets, values)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.unique(shingle_hashes(words[a:b], size))


# Bytes that may begin a multi-byte white space character.
_UNSURE = np.zeros(256, bool)
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
# Punctuation that every pattern separates from letters.
_MARK = np.zeros(256, bool)
_MARK[[0x2C, 0x2E]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def cuts_between_words(raw: np.ndarray, keep_space: bool) -> np.ndarray:
    """Positions (mask of n + 1) where a text may be cut without changing its tokens.

    ``keep_space``: for byte-level patterns, whose words carry one space in front. A cut is
    before a white space run behind a character that is surely not white space, and behind
    a single line feed in front of such a character. Otherwise white space is dropped by the
    pattern, and a text may be cut at either side of it, and where a letter meets ``,`` or ``.``.
    """
    n = len(raw)
    out = np.zeros(n + 1, bool)
    out[0] = out[n] = True
    if n < 2:
        return out
    blank = SPACE[raw]
    if not keep_space:
        mark, letter = _MARK[raw], _LETTER[raw]
        out[1:n] = (blank[1:] != blank[:-1]) | (mark[1:] & letter[:-1]) | (mark[:-1] & letter[1:])
        return out
    doubt = _UNSURE[raw]
    solid = ~(blank | doubt | (raw < 0x20))
    solid[1:] &= ~doubt[:-1]
    solid[2:] &= ~doubt[:-2]
    out[1:n] = blank[1:] & solid[:-1]
    single = (raw[1:-1] == 0x0A) & solid[:-2] & solid[2:]
    out[2:n] |= single
    return out


def segments(raw: np.ndarray, offsets: np.ndarray, keep_space: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of (begin, end, hash) of the segments that rows are cut into, in order.

    Segments never cross rows. Without ``keep_space`` blank segments are left out.
    """
    cut = cuts_between_words(raw, keep_space)
    cut[offsets] = True
    for a, b in windows(raw, lambda x, y: cut[x:y]):
        begin = np.flatnonzero(cut[a:b])
        end = np.append(begin[1:], b - a)
        if not keep_space:
            full = ~SPACE[raw[a + begin]]
            begin, end = begin[full], end[full]
        sums, down = prefix_hashes(raw[a:b], BYTE_VALUES)
        yield begin + a, end + a, mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ahead = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ahead, lengths)


class Known:
    """Numbers of hashes in order of their first sight, in sorted arrays of 12 bytes each."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int32)

    def find(self, distinct: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for new ones."""
        if not len(self.hashes):
            return np.full(len(distinct), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return np.where(self.hashes[at] == distinct, self.numbers[at], -1)

    def add(self, new: np.ndarray) -> np.ndarray:
        """Take in sorted new hashes; their numbers."""
        numbers = np.arange(len(self.hashes), len(self.hashes) + len(new), dtype=np.int32)
        at = np.searchsorted(self.hashes, new)
        self.hashes = np.insert(self.hashes, at, new)
        self.numbers = np.insert(self.numbers, at, numbers)
        return numbers
