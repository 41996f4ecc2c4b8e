"""Numbers of unigram tokens without the tokens: a count-only Viterbi search.

A text is cut at spaces and at space marks (U+2581), each of which opens a word with a mark, as
unigram tokenizers do; a text that begins with neither gets a mark.
An Aho-Corasick automaton of the vocabulary finds all its pieces in a word; dynamic programming
over the word's characters carries the best score and its number of pieces, nothing else. Tie
rules are the tokenizer's: of equal scores the piece that begins first wins, and a character
without a piece of its own counts last, at the lowest score less 10, as its UTF-8 bytes. Each
distinct word of a chunk is searched once, and kept up to a bound.

The vocabulary is read from a sentencepiece file, whose piece scores are taken as they are.
Empty or NULL text: no tokens, score 0. Rows that repeat are counted like any other; only the
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of, chunks
from revlens.llm.strings import BYTE_VALUES, Known, mix, prefix_hashes, utf8, windows

# The space mark, and the penalty of characters without a piece.
MARK = "▁"
MARK_BYTES = MARK.encode()
PENALTY = 10.0
UNKNOWN_ID = 0
KEPT_WORDS = 1_000_000


def pieces(path: str) -> list[tuple[str, float]]:
    """All pieces of a sentencepiece file with their scores, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Search:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, number == UNKNOWN_ID))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - PENALTY
        self.unknown_bytes = len(vocabulary[UNKNOWN_ID][0].encode())

    def best(self, word: str) -> tuple[int, float]:
        """(number of pieces, score) of the best split of one word.

        Unknown parts in a row are written as bytes, except the unknown piece by itself, which is
        one token. ``runs`` has 0 where the last part is known, 1 behind that piece, else 2.
        """
        n = len(word)
        scores: list[float | None] = [0.0] + [None] * n
        counts, runs = [0] * (n + 1), [0] * (n + 1)
        done, single, spare = 0, False, self.unknown_bytes - 1

        def close(end: int) -> None:
            if not single:
                score = scores[end - 1] + self.unknown
                if scores[end] is None or score > scores[end]:
                    ahead = counts[end - 1] + (spare if runs[end - 1] == 1 else 0)
                    scores[end], counts[end], runs[end] = score, ahead + len(word[end - 1].encode()), 2

        for last, (length, value, unknown) in self.automaton.iter(word):
            end = last + 1
            while done + 1 < end:
                done += 1
                close(done)
                single = False
            begin = end - length
            score = scores[begin] + value
            if scores[end] is None or score > scores[end]:
                scores[end] = score
                if unknown:
                    counts[end] = counts[begin] + (1, 2 * spare + 1, spare + 1)[runs[begin]]
                    runs[end] = 2 if runs[begin] else 1
                else:
                    counts[end], runs[end] = counts[begin] + 1, 0
            single = single or length == 1
        while done < n:
            done += 1
            close(done)
            single = False
        return counts[n], scores[n]


@lru_cache(maxsize=2)
def _search(path: str) -> Search:
    return Search(pieces(path))


def _words(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of (begin, end, hash) of the words: from each space, and each text's begin, on."""
    # Bytes that the mark in front of a word takes: a space's one, or the three of a mark itself.
    lead = (raw == 0x20).astype(np.int64)
    lead[:-2][(raw[:-2] == MARK_BYTES[0]) & (raw[1:-1] == MARK_BYTES[1]) & (raw[2:] == MARK_BYTES[2])] = 3
    cut = np.zeros(len(raw) + 1, bool)
    cut[:-1] = lead > 0
    cut[offsets] = True
    for a, b in windows(raw, lambda x, y: cut[x:y]):
        begin = np.flatnonzero(cut[a:b])
        end = np.append(begin[1:], b - a)
        begin = begin + lead[a + begin]
        sums, down = prefix_hashes(raw[a:b], BYTE_VALUES)
        yield begin + a, end + a, mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def count(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score) of every row; ``path`` is the same on every executor."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, known, best = _search(path), Known(), np.zeros((0, 2))
        for batch in chunks(batches, 1):
            raw, offsets = utf8(batch.column(1))
            if len(best) > KEPT_WORDS:
                known, best = Known(), np.zeros((0, 2))
            totals = np.zeros(len(raw) + 1, np.int64)
            scores = np.zeros(len(raw) + 1)
            for begin, end, hashes in _words(raw, offsets):
                distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                number = known.find(distinct)
                missing = np.flatnonzero(number < 0)
                if len(missing):
                    at, data = first[missing], raw[begin[0] : end[-1]].tobytes()
                    places = zip((begin[at] - begin[0]).tolist(), (end[at] - begin[0]).tolist())
                    found = [search.best(MARK + data[a:b].decode()) for a, b in places]
                    number[missing] = known.add(distinct[missing])
                    best = np.concatenate([best, np.array(found, float).reshape(-1, 2)])
                values = best[number[inverse]]
                # A word stands where it begins; with its space gone it may begin where it ends.
                np.add.at(totals, end - 1, values[:, 0].astype(np.int64))
                np.add.at(scores, end - 1, values[:, 1])
            upto = np.append(0, np.cumsum(totals))
            scored = np.append(0, np.cumsum(scores))
            a, b = offsets[:-1], offsets[1:]
            yield batch_of(
                ["doc_id", "n_tokens", "score"],
                [batch.column(0), upto[b] - upto[a], scored[b] - scored[a]],
                [pa.int64(), pa.int64(), pa.float64()],
            )

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, score double")
