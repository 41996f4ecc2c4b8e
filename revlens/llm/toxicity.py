"""A convolutional text classifier for toxic documents, trained in numpy.

A word is the sum of two hashed embeddings, of the word and of its beginning. Filters over one,
two and three words run over the whole text, their largest answers (max pooling) feed a logistic
layer. Texts become bucket numbers in the tasks. Every labelled row is used: four in five are
learned from, the fifth sets the thresholds. The rows are dealt by their ids to shards of about
``SHARD_BYTES`` of text. A learner for each shard goes ``PASSES`` times over its rows, in ``ROUNDS``
rounds that all learners begin with the same model; after each round their changes are averaged,
in whole numbers, so that no order of tasks matters. One shard is learned in one task. The model, a
few megabytes whatever the data, then scores every text in parallel, in blocks of a long one.

The rows not learned from set, for each language, the threshold that balances caught and wrongly
accused documents best, exactly, by windows over ranges of margins; languages with few toxic rows
lean on the threshold of all. The language is guessed from the text's function words. Scores are
shifted so that the threshold is 0.5. Only the text counts for a score.

NULL and empty texts, and texts without words, score what a text without any signal does. Rows
that repeat score alike. Without toxic or without clean rows to learn from, every score is 0.
Labels that are NULL, and rows without an id, are not learned from. Only the id, text and label
columns are read, so other columns never clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of, chunks
from revlens.llm.store import Workspace
from revlens.llm.strings import BYTE_VALUES, mix, prefix_hashes, utf8, windows

SHARD_BYTES = 64 << 20
ROUNDS, PASSES = 3, 2
BUCKETS, WIDTH = 1 << 16, 16
FILTERS, WIDTHS = 16, (1, 2, 3)
BEGINNING = 4  # letters
STEP_COUNT = 255
PAD = 2  # empty words around a text, one less than the widest filter
BLOCK = 1 << 16
STEPS, BATCH, RATE = 400, 32, 0.01  # steps at least, however few the rows
BATCH_WORDS = 1 << 20  # a batch with long texts has fewer of them
MERGED_ROWS = 1024  # rows of the model's tables that are averaged together
FRACTION = 1 << 20  # changes are averaged in this part of one
MARGIN_BINS = 64  # ranges for each unit of a margin, within MARGIN_LIMIT
MARGIN_LIMIT = 64
LEAN = 20.0  # toxic rows that a language's own threshold counts as much as that of all
SEED = 13

# Frequent function words that tell a language.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for it with as on by this from are",
    "de": "der die und das den von zu mit sich auf für im dem nicht ein eine ist",
    "fr": "le la les des et du une dans qui que par pour sur est au avec il",
    "es": "el los las del y en una con por para su al lo como más pero sus",
}
LANGUAGES = ["", *FUNCTION_WORDS]

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a character


def folded(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capital letters of Latin-1 in small letters."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    accent = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[:-1] == 0xC3)) + 1
    out[accent] += 32
    return out


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, rows): a bucket pair (word, beginning) per word, and n + 1 positions of the rows in them."""
    raw, offsets = utf8(column)
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    found, starts = [np.zeros((0, 2), np.uint16)], [np.zeros(0, np.int64)]
    for a, b in windows(raw, lambda x, y: ~_WORD[raw[x - 1 : y - 1]] | edge[x:y]):
        piece = folded(raw[a:b])
        inside = _WORD[piece]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[a + 1 : b]
        ends[:-1] &= ~inside[1:] | edge[a + 1 : b]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if not len(s):
            continue
        sums, down = prefix_hashes(piece, BYTE_VALUES)
        # The end of the fourth character, for characters of several bytes.
        lead = np.flatnonzero(np.append(_LEAD[piece], True))
        rank = np.searchsorted(lead, s)
        short = np.minimum(lead[np.minimum(rank + BEGINNING, len(lead) - 1)], e)
        codes = np.stack([mix((sums[x] - sums[s]) * down[s]) for x in (e, short)], axis=1)
        found.append((codes >> np.uint64(48)).astype(np.uint16))
        starts.append(s + a)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), offsets)


@lru_cache(maxsize=1)
def _language_of_buckets() -> np.ndarray:
    """The language (0: none) whose function word has a bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for number, words in enumerate(FUNCTION_WORDS.values(), 1):
        codes, _ = buckets(pa.array([words]))
        out[codes[:, 0]] = number
    return out


def languages(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each row the language with most function words in it, 0 without any."""
    spoken = _language_of_buckets()[words[:, 0]]
    at = np.flatnonzero(spoken)
    row = np.searchsorted(rows, at, "right") - 1
    count = np.bincount(row * len(LANGUAGES) + spoken[at], minlength=(len(rows) - 1) * len(LANGUAGES))
    return count.reshape(-1, len(LANGUAGES)).argmax(axis=1)


@dataclass
class Model:
    """Embeddings of words and beginnings, filters of each width, and the logistic layer."""

    words: np.ndarray
    beginnings: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray
    scale: np.ndarray

    @classmethod
    def fresh(cls, random: np.random.Generator) -> Model:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        size = FILTERS * len(WIDTHS)
        filters = [normal(k * WIDTH, FILTERS, scale=(k * WIDTH) ** -0.5) for k in WIDTHS]
        return cls(
            normal(BUCKETS, WIDTH, scale=0.1), normal(BUCKETS, WIDTH, scale=0.1), filters, np.zeros(size, np.float32),
            normal(size, scale=size**-0.5), 0.0, np.zeros(len(LANGUAGES)), np.ones(size, np.float32),
        )

    def embedded(self, words: np.ndarray) -> np.ndarray:
        return self.words[words[:, 0]] + self.beginnings[words[:, 1]]

    def pooled(self, words: np.ndarray, rows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(largest answer of each filter per row, and its place in the padded words of all rows).

        Every row has ``PAD`` empty words in front; those of the next row end it.
        """
        sizes = np.diff(rows) + PAD
        starts = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        place_of = np.arange(len(words)) + np.repeat(PAD * np.arange(1, len(sizes) + 1), np.diff(rows))
        best = np.full((len(sizes), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        where = np.zeros(best.shape, np.int64)
        for a in range(0, total, BLOCK):
            b = min(a + BLOCK, total)
            first, last = np.searchsorted(place_of, [a, b + PAD])
            x = np.zeros((b - a + PAD, WIDTH), np.float32)
            x[place_of[first:last] - a] = self.embedded(words[first:last])
            answers = np.concatenate([self._answers(x, k, f, b - a) for k, f in zip(WIDTHS, self.filters)], axis=1)
            row = np.searchsorted(starts, a, "right") - 1
            until = np.searchsorted(starts, b)
            begin = np.maximum(starts[row:until] - a, 0)
            if places:
                for r, s, e in zip(range(row, until), begin, np.append(begin[1:], b - a)):
                    at = answers[s:e].argmax(axis=0)
                    value = answers[s + at, np.arange(len(at))]
                    where[r] = np.where(value > best[r], a + s + at, where[r])
                    best[r] = np.maximum(best[r], value)
            else:
                best[row:until] = np.maximum(best[row:until], np.maximum.reduceat(answers, begin, axis=0))
        return best * self.scale + self.biases, where

    def in_steps(self) -> Model:
        """The model with tables and filters in whole steps, a ``STEP_COUNT``-th of their largest value.

        Sums of products of whole numbers below 2^24 are exact in any order, so that a text's
        score does not depend on the texts around it.
        """
        step = max(np.abs(self.words).max(), np.abs(self.beginnings).max()) / STEP_COUNT
        steps = [np.abs(f).max() / STEP_COUNT for f in self.filters]
        return replace(
            self,
            words=np.round(self.words / step),
            beginnings=np.round(self.beginnings / step),
            filters=[np.round(f / s) for f, s in zip(self.filters, steps)],
            scale=np.repeat(np.array(steps, np.float32) * np.float32(step), FILTERS),
        )

    @staticmethod
    def _answers(x: np.ndarray, width: int, filters: np.ndarray, n: int) -> np.ndarray:
        out = x[:n] @ filters[:WIDTH]
        for j in range(1, width):
            out += x[j : j + n] @ filters[j * WIDTH : (j + 1) * WIDTH]
        return out

    def margins(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How toxic each row is, before the thresholds; 0 is as likely as not in what was learned from."""
        if len(rows) < 2:
            return np.zeros(0)
        pooled, _ = self.pooled(words, rows)
        return (np.maximum(pooled, 0).astype(np.float64) * self.weights).sum(axis=1) + self.bias

    def scores(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        shifted = self.margins(words, rows) - self.thresholds[languages(words, rows)]
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


class _Adam:
    """Steps of Adam, ever smaller until the last one; ``rows`` touches some rows of a table only.

    ``done`` of all steps were made in earlier rounds.
    """

    def __init__(self, done: int, last: int, *values: np.ndarray):
        self.values, self.done, self.last = values, done, last
        self.first = [np.zeros_like(v) for v in values]
        self.second = [np.zeros_like(v) for v in values]
        self.steps = 0

    def step(self, grads: list[tuple[np.ndarray, np.ndarray | slice]]) -> None:
        self.steps += 1
        rate = RATE * (1 - (self.done + self.steps - 1) / self.last) * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        for value, m, v, (grad, rows) in zip(self.values, self.first, self.second, grads):
            m[rows] = 0.9 * m[rows] + 0.1 * grad
            v[rows] = 0.999 * v[rows] + 0.001 * grad * grad
            value[rows] -= rate * m[rows] / (np.sqrt(v[rows]) + 1e-8)


def _summed(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(rows, return_inverse=True)
    out = np.zeros((len(distinct), grads.shape[1]), np.float32)
    np.add.at(out, inverse, grads)
    return out, distinct


def _steps(rows: int) -> int:
    return max(STEPS, PASSES * -(-rows // BATCH))


def _batches(texts: list[np.ndarray], chosen: np.ndarray) -> Iterator[np.ndarray]:
    """The chosen texts in turn, fewer at a time where they are long."""
    held = np.cumsum([len(texts[i]) for i in chosen]) // BATCH_WORDS
    yield from np.split(chosen, np.flatnonzero(np.diff(held)) + 1)


def improve(model: Model, texts: list[np.ndarray], toxic: np.ndarray, share: float, random: np.random.Generator, turn: int = 0, turns: int = 1, steps: int | None = None) -> None:
    """One of ``turns`` rounds over (words, 2) bucket arrays, which together visit every text.

    ``share`` of all rows are toxic; both labels weigh the same. All rounds begin with the same ``random``.
    """
    steps = steps or _steps(len(texts))
    visits = np.concatenate([random.permutation(len(texts)) for _ in range(-(-steps * BATCH // len(texts)))])[: steps * BATCH].reshape(steps, BATCH)
    begin, end = turn * steps // turns, (turn + 1) * steps // turns
    random = np.random.default_rng([turn, *random.integers(0, 1 << 32, 4)]) if turn else random
    bias = np.array([model.bias], np.float32)
    adam = _Adam(begin, steps, model.words, model.beginnings, *model.filters, model.biases, model.weights, bias)
    weight = np.where(toxic, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)
    every = slice(None)
    for chosen in (part for visit in visits[begin:end] for part in _batches(texts, visit)):
        sizes = np.array([len(texts[i]) for i in chosen])
        words = np.concatenate([texts[i] for i in chosen])
        rows = np.append(0, np.cumsum(sizes))
        pooled, where = model.pooled(words, rows, places=True)
        alive = (pooled > 0) & (random.random(pooled.shape) > 0.25)
        hidden = np.where(alive, pooled, 0)
        wrong = (1 / (1 + np.exp(-(hidden @ model.weights + bias[0]))) - toxic[chosen]) * weight[chosen] / BATCH
        back = np.where(alive, wrong[:, None] * model.weights, 0).astype(np.float32)
        grads = [_filter_grads(model, words, sizes, where, back)]
        table, beginnings, filters = grads[0]
        adam.step([table, beginnings, *((g, every) for g in filters), (back.sum(axis=0), every), ((wrong[:, None] * hidden).sum(axis=0).astype(np.float32), every), (wrong.sum(keepdims=True).astype(np.float32), every)])
    model.bias = float(bias[0])


def fit(texts: list[np.ndarray], toxic: np.ndarray, steps: int = STEPS) -> Model:
    """Learn from (words, 2) bucket arrays in ``steps`` batches."""
    random = np.random.default_rng(SEED)
    model = Model.fresh(random)
    improve(model, texts, toxic, float(toxic.mean()), random, steps=steps)
    return model.in_steps()


def _filter_grads(model: Model, words: np.ndarray, sizes: np.ndarray, where: np.ndarray, back: np.ndarray) -> tuple:
    """Gradients of both tables and the filters, through the words under each largest answer."""
    place_of = np.arange(len(words)) + np.repeat(PAD * np.arange(1, len(sizes) + 1), sizes)
    number = np.full(int(sizes.sum()) + PAD * (len(sizes) + 1), -1)
    number[place_of] = np.arange(len(words))
    filters, ids, grads = [], [], []
    for k, (width, table) in enumerate(zip(WIDTHS, model.filters)):
        mine = slice(k * FILTERS, (k + 1) * FILTERS)
        out = np.zeros_like(table)
        for j in range(width):
            at = number[where[:, mine] + j]
            x = np.where(at[..., None] >= 0, model.embedded(words[at.ravel()]).reshape(*at.shape, WIDTH) if len(words) else 0, 0)
            part = slice(j * WIDTH, (j + 1) * WIDTH)
            out[part] = np.einsum("rfd,rf->df", x, back[:, mine])
            used = (at >= 0) & (back[:, mine] != 0)
            ids.append(at[used])
            grads.append((back[:, mine][..., None] * table[part].T[None])[used])
        filters.append(out)
    at, grad = np.concatenate(ids), np.concatenate(grads)
    return _summed(words[at, 0], grad), _summed(words[at, 1], grad), filters


def best_threshold(margins: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> float:
    """The margin with the best balance (F1) of caught and wrongly accused weight; the middle of its gap."""
    order = np.argsort(-margins, kind="stable")
    margins, toxic, weights = margins[order], toxic[order], weights[order]
    caught, accused = np.cumsum(weights * toxic), np.cumsum(weights)
    f1 = 2 * caught / (accused + (weights * toxic).sum())
    f1[:-1][margins[:-1] == margins[1:]] = -1
    at = int(f1.argmax())
    below = margins[at + 1] if at + 1 < len(margins) else margins[at] - 2.0
    return float((margins[at] + below) / 2)


def thresholds(space: Workspace, margins: DataFrame) -> np.ndarray:
    """The threshold of each language from (language, margin, toxic) of all rows: ``best_threshold`` as windows.

    Counts of ranges of margins come first, so that no window holds more than the different
    margins of one range, or one row for each range.
    """
    everything = -1
    own = margins.select(F.explode(F.array(F.lit(everything), "language")).alias("language"), "margin", "toxic")
    bounded = F.greatest(F.lit(float(-MARGIN_LIMIT)), F.least(F.lit(float(MARGIN_LIMIT)), "margin"))
    counted = own.groupBy("language", "margin").agg(F.sum("toxic").alias("caught"), F.count("*").alias("accused"))
    counts = space.put(counted.withColumn("bin", F.floor(bounded * MARGIN_BINS)))
    bins = counts.groupBy("language", "bin").agg(F.sum("caught").alias("c"), F.sum("accused").alias("a"))
    all_bins, down = Window.partitionBy("language"), Window.partitionBy("language").orderBy(F.desc("bin"))
    above = bins.select(
        "language", "bin", F.sum("c").over(all_bins).alias("positive"), F.sum("a").over(all_bins).alias("total"),
        (F.sum("c").over(down) - F.col("c")).alias("c"), (F.sum("a").over(down) - F.col("a")).alias("a"),
    )
    inside = Window.partitionBy("language", "bin").orderBy(F.desc("margin"))
    caught, accused = F.col("c") + F.sum("caught").over(inside), F.col("a") + F.sum("accused").over(inside)
    judged = counts.join(above, ["language", "bin"]).where((F.col("positive") > 0) & (F.col("positive") < F.col("total")))
    balance = judged.select("language", "margin", "positive", (2.0 * caught / (accused + F.col("positive"))).alias("f1"))
    best = space.put(balance.groupBy("language").agg(F.max(F.struct("f1", "margin")).alias("best"), F.first("positive").alias("positive")))
    lower = counts.join(F.broadcast(best), "language").where(F.col("margin") < F.col("best.margin")).groupBy("language").agg(F.max("margin").alias("below"))
    found = {r.language: r for r in best.join(lower, "language", "left").collect()}  # one row for each language
    out = np.zeros(len(LANGUAGES))
    if everything not in found:
        return out
    middle = {k: (r.best.margin + (r.best.margin - 2.0 if r.below is None else r.below)) / 2 for k, r in found.items()}
    for language in range(len(LANGUAGES)):
        n = float(found[language].positive) if language in found else 0.0
        out[language] = (n * middle.get(language, 0.0) + LEAN * middle[everything]) / (n + LEAN)
    return out


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row's label is kept for judging the scores: one checksum of the id in five."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _labelled(space: Workspace, docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """((shard, toxic, fits, codes) of every labelled text, each shard's rows together, and the number of shards).

    An id with both labels is toxic. Texts with one id count each, equal ones once. Labels and texts
    meet by shard, labels first, so that texts are moved once.
    """
    wanted = F.col("doc_id").isNotNull() & ~held_out()
    known = labels.where(wanted & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(wanted)
    held = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = max(1, -(-held // SHARD_BYTES))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            words, rows = buckets(batch.column(1))
            data = words.tobytes()
            cut = [data[a:b] for a, b in zip((4 * rows[:-1]).tolist(), (4 * rows[1:]).tolist())]
            yield batch_of(["doc_id", "codes"], [batch.column(0), cut], [None, pa.binary()])

    coded = texts.mapInArrow(code, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, codes binary")
    both = known.select("doc_id", "toxic", F.lit(None).cast("binary").alias("codes")).union(coded.select("doc_id", F.lit(None).cast("int").alias("toxic"), "codes"))
    placed = both.withColumn("order", F.xxhash64("doc_id", F.lit(SEED))).withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)).cast("int"))
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "order", "doc_id", F.col("codes").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = label = seen = None
        for batch in batches:
            out = [[], [], [], []]
            for doc, toxic, codes, order, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if doc != last:
                    last, label, seen = doc, None, None
                if codes is None:
                    label = toxic
                elif label is not None and codes != seen:
                    seen = codes
                    for column, value in zip(out, (shard, label, order % 5 > 0, codes)):
                        column.append(value)
            yield batch_of(["shard", "toxic", "fits", "codes"], out, [pa.int32(), pa.int32(), pa.bool_(), pa.binary()])

    met = dealt.select("doc_id", "toxic", "codes", "order", "shard").mapInArrow(run, "shard int, toxic int, fits boolean, codes binary")
    return space.put(met), shards


def _texts_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint16).reshape(-1, 2) for c in column.to_pylist()]


def _flat(model: Model) -> np.ndarray:
    """All numbers of the model as rows of ``WIDTH``: both tables, then the rest."""
    rest = np.concatenate([*(f.ravel() for f in model.filters), model.biases, model.weights, [model.bias]]).astype(np.float32)
    return np.concatenate([model.words, model.beginnings, np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)])


def _with_flat(model: Model, flat: np.ndarray) -> Model:
    rest, filters, at = flat[2 * BUCKETS :].ravel(), [], 0
    for f in model.filters:
        filters.append(rest[at : at + f.size].reshape(f.shape).copy())
        at += f.size
    n = FILTERS * len(WIDTHS)
    return replace(
        model, words=flat[:BUCKETS].copy(), beginnings=flat[BUCKETS : 2 * BUCKETS].copy(), filters=filters,
        biases=rest[at : at + n].copy(), weights=rest[at + n : at + 2 * n].copy(), bias=float(rest[at + 2 * n]),
    )


def _averaged(rows: DataFrame, model: Model, share: float, turn: int, turns: int) -> Model:
    """``model`` after one round of all learners; a row of its tables moves by the mean of those that used it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # some megabytes, whatever the data

    def changes(shard: int, texts: list[np.ndarray], toxic: list[int]) -> pa.RecordBatch:
        start = _flat(shared.value)
        own = _with_flat(shared.value, start)
        improve(own, texts, np.array(toxic, float), share, np.random.default_rng([SEED, shard]), turn, turns)
        moved = np.round((_flat(own) - start).astype(np.float64) * FRACTION).astype(np.int32)
        used = np.flatnonzero(moved.any(axis=1))
        parts = np.split(used, np.flatnonzero(np.diff(used // MERGED_ROWS)) + 1) if len(used) else []
        data = [[int(p[0]) // MERGED_ROWS for p in parts], [(p % MERGED_ROWS).astype(np.uint16).tobytes() for p in parts], [moved[p].tobytes() for p in parts]]
        return batch_of(["part", "at", "moved"], data, [pa.int32(), pa.binary(), pa.binary()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, texts, toxic = None, [], []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for a in np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))[: len(numbers)].tolist():
                same = batch.slice(a, int((numbers[a:] == numbers[a]).sum()))
                if texts and shard != numbers[a]:
                    yield changes(shard, texts, toxic)
                    texts, toxic = [], []
                shard = int(numbers[a])
                texts += _texts_of(same.column(2))
                toxic += same.column(1).to_pylist()
        if texts:
            yield changes(shard, texts, toxic)

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        total, learners = np.zeros((MERGED_ROWS, WIDTH), np.int64), np.zeros(MERGED_ROWS, np.int64)
        for at, moved in zip(group["at"], group["moved"]):
            rows = np.frombuffer(at, np.uint16)
            total[rows] += np.frombuffer(moved, np.int32).reshape(-1, WIDTH)
            learners[rows] += 1
        average = total / np.maximum(learners, 1)[:, None] / FRACTION
        return pd.DataFrame({"part": group["part"].iloc[:1], "change": [average.astype(np.float32).tobytes()]})

    learned = rows.select("shard", "toxic", "codes").mapInArrow(run, "part int, at binary, moved binary")
    flat = _flat(model)
    for row in learned.groupBy("part").applyInPandas(mean, "part int, change binary").collect():  # as large as the model
        part = flat[row.part * MERGED_ROWS : (row.part + 1) * MERGED_ROWS]
        part += np.frombuffer(row.change, np.float32).reshape(-1, WIDTH)[: len(part)]
    shared.unpersist()
    return _with_flat(model, flat)


def _alone(rows: DataFrame, steps: int) -> Model:
    """What one learner makes of the rows of one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            toxic = np.concatenate([b.column(0).to_numpy() for b in held]).astype(float)
            yield batch_of(["model"], [[pickle.dumps(fit([t for b in held for t in _texts_of(b.column(1))], toxic, steps))]], [pa.binary()])

    return pickle.loads(rows.select("toxic", "codes").coalesce(1).mapInArrow(run, "model binary").first().model)


def _margins(rows: DataFrame, model: Model) -> DataFrame:
    """(language, margin, toxic) of labelled rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            texts = _texts_of(batch.column(1))
            if texts:
                words, bounds = np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts]))
                data = [languages(words, bounds), shared.value.margins(words, bounds), batch.column(0)]
                yield batch_of(["language", "margin", "toxic"], data, [pa.int32(), pa.float64(), None])

    return rows.select("toxic", "codes").mapInArrow(run, "language int, margin double, toxic int")


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the labelled rows that are not held out (starts jobs); None without both labels."""
    space = Workspace(docs.sparkSession)
    rows, shards = _labelled(space, docs, labels)
    fits = rows.where("fits")
    total, toxic = fits.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == total:
        return None
    if shards == 1:
        model = _alone(fits, _steps(total))
    else:
        model = Model.fresh(np.random.default_rng(SEED))
        for turn in range(ROUNDS):
            model = _averaged(fits, model, toxic / total, turn, ROUNDS)
        model = model.in_steps()
    model.thresholds = thresholds(space, _margins(rows.where("not fits"), model))
    space.drop(rows)
    return model


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score): 0 to 1, higher is likelier toxic; every text is read whole."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some megabytes, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            yield batch_of(["doc_id", "score"], [batch.column(0), shared.value.scores(*buckets(batch.column(1)))], [None, pa.float64()])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all documents, learned from ``labels`` (starts jobs)."""
    scores = score(docs, learn(docs, labels))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
