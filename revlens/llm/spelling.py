"""Words that differ in one character, found among the sorted rotations of all words.

A word ends in a mark, and each of its rotations brings another character to the end. Rotations
that are alike but for the last character belong to words with one character replaced; a rotation
that equals another one without its last character belongs to a word with that character inserted.
So rotations are dealt out and sorted by what is in front of the edited character: the neighbours
of an edit stand side by side. Such a group has at most one word for each letter, and one word
that lacks the character. A scan gives each word its number of neighbours in the group and the
most frequent of them, never their pairs; both add up over groups. Where a character stands in a
row of equal ones, only the first counts as inserted, so a pair of words meets in one group only.
Words of more than ``SPELT`` letters are treated alike, but codes stand for their rotations.

Texts that are NULL or without long words have none; a NULL id is an empty text in checksums. A
document that is there twice counts twice. Only the id and text columns are read, so other columns
never clash. Without words the result is empty. Long texts are read whole, in one row.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of
from revlens.llm.store import Workspace

LEAST_LETTERS, LEAST_TIMES = 7, 2
FORM_TIMES = 10
# The characters of words, and one checksum in so many that loses a character.
LETTERS = "A-Za-zÀ-ÿ"
DAMAGE = 31
MARK = "$"
# How a word is in a group: without the character, with it, with the first of equal ones.
WHOLE, WITH, WITH_FIRST = 0, 1, 2
_NONE = np.iinfo(np.int64).max
LINKS = ["word", "near", "best_n", "best"]
# Rotations of words with more letters are coded: as numbers modulo primes, from these bases.
SPELT = 64
CODES = ((2147483647, 912_345_671), (2147483629, 1_402_537_207), (2147483587, 333_667_001), (2147483579, 1_871_093_117))
ROWS = 50_000


def occurrences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word): every long word of the texts, A-Z in small letters; some lose a character."""
    runs = F.regexp_extract_all(F.col(text_column).cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    small = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    lowered = found.select("id", F.when(F.col("run").rlike("[A-Z]"), small).otherwise(F.col("run")).alias("run"))
    code = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (F.col("code") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = lowered.select("run", code.alias("code")).select(F.when(F.col("code") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LETTERS)


def counted(words: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough; counts are added up before they are shuffled."""
    return words.groupBy("word").agg(F.count("word").alias("n")).where(F.col("n") >= LEAST_TIMES)


def rotations(words: DataFrame) -> DataFrame:
    """(front, letter, mark, n) of all rotations, once whole and once without their last letter."""
    size = F.length("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), 2 * size)).alias("i"))
    whole = F.col("i") <= size
    at = F.when(whole, F.col("i")).otherwise(F.col("i") - size - 1)
    begun = turned.select("word", "n", whole.alias("whole"), at.alias("at"))
    letter = F.substring("word", F.col("at") + 1, F.lit(1))
    behind = F.substring("word", F.col("at") + F.when(F.col("whole"), 1).otherwise(2), size)
    first = (F.col("at") == 0) | (F.substring("word", F.col("at"), F.lit(1)) != letter)
    return begun.select(
        F.concat(behind, F.lit(MARK), F.substring("word", F.lit(1), F.col("at"))).alias("front"),
        F.when(F.col("whole"), "").otherwise(letter).alias("letter"),
        F.when(F.col("whole"), WHOLE).when(first, WITH_FIRST).otherwise(WITH).alias("mark"),
        "n",
    )


def _links(n: np.ndarray, mark: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of neighbours, row of the best one) of whole groups of two rows or more.

    Rows are sorted by number, then letter. A row may appear twice, once for each kind of edit.
    """
    sizes = np.diff(np.append(starts, len(n)))
    row, group = np.arange(len(n)), np.repeat(np.arange(len(sizes)), sizes)

    def first(of: np.ndarray) -> np.ndarray:
        """The first row of each group among some rows."""
        return np.minimum.reduceat(np.where(of, row, _NONE), starts)

    present, one_of_row = mark > WHOLE, mark == WITH_FIRST
    n_present, n_first = (np.add.reduceat(m.astype(np.int64), starts) for m in (present, one_of_row))
    top = first(present)
    second = first(present & (row != top[group]))
    lacking, top_first = first(mark == WHOLE), first(one_of_row)
    replaced = np.flatnonzero(present & (n_present[group] > 1))
    other = group[replaced]
    longer = np.flatnonzero(one_of_row & (lacking[group] != _NONE))
    shorter = np.flatnonzero((lacking != _NONE) & (n_first > 0))
    who = np.concatenate([replaced, longer, lacking[shorter]])
    near = np.concatenate([n_present[other] - 1, np.ones(len(longer), np.int64), n_first[shorter]])
    best = np.concatenate([np.where(replaced == top[other], second[other], top[other]), lacking[group[longer]], top_first[shorter]])
    return who, near, best


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, starts): the groups of two rows or more with equal first columns; batches may cut groups."""
    held = None

    def larger(rows: pa.RecordBatch, starts: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
        sizes = np.diff(np.append(starts, rows.num_rows))
        many = sizes > 1
        return rows.filter(pa.array(np.repeat(many, sizes))), np.cumsum(sizes[many]) - sizes[many]

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        front = rows.column(0)
        starts = np.flatnonzero(pc.not_equal(front.slice(1), front.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)) + 1
        last = int(starts[-1]) if len(starts) else 0
        if last:
            yield larger(rows.slice(0, last), np.append(0, starts[:-1]))
        held = rows.slice(last)
    if held is not None:
        yield larger(held, np.zeros(1, np.int64))


def _short_links(words: DataFrame) -> DataFrame:
    """(word, near, best_n, best) for each group that a word has neighbours in."""
    # Sorting by the front puts a group side by side; a word is spelt by its front and letter.
    dealt = rotations(words).repartition("front").sortWithinPartitions("front", F.desc("n"), "letter")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _grouped(batches):
            if rows.num_rows:
                n = rows.column(3).to_numpy()
                who, near, best = _links(n, rows.column(2).to_numpy(), starts)
                halves = pc.split_pattern(rows.column(0), MARK)
                spelt = pc.binary_join_element_wise(pc.list_element(halves, 1), rows.column(1), pc.list_element(halves, 0), "")
                yield batch_of(LINKS, [spelt.take(pa.array(who)), near, n[best], spelt.take(pa.array(best))], [pa.string(), pa.int64(), pa.int64(), pa.string()])

    return dealt.mapInArrow(scan, "word string, near bigint, best_n bigint, best string")


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    """base^0, base^1, … modulo a prime below 2^31, by doubling."""
    out = np.ones(size, np.int64)
    done = 1
    while done < size:
        take = min(done, size - done)
        out[done : done + take] = out[:take] * pow(base, done, prime) % prime
        done += take
    return out


def _front_codes(letters: np.ndarray, prime: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all whole rotations, and of those without their last letter, from running sums."""
    size = len(letters)
    up, down = _powers(base, prime, size + 2), _powers(pow(base, -1, prime), prime, size + 2)
    sums = np.append(0, np.cumsum(letters * up[:size] % prime)) % prime
    at = np.arange(size + 1)

    def code(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the letters from ``begin`` on, the mark, and the letters up to ``end``."""
        behind = (sums[size] - sums[begin]) % prime * down[begin] % prime
        length = size - begin
        return (behind + ord(MARK) * up[length] + sums[end] * up[length + 1] % prime) % prime

    return code(at, at), code(at[1:], at[:-1])


def _long_links(words: DataFrame) -> DataFrame:
    """The same for long words, whose fronts and names are codes of 124 and 128 bits.

    A word then takes as much space as it has letters, and not the square of it.
    """
    named = words.select("word", "n", F.unhex(F.md5("word")).alias("name"))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["front", "letter", "mark", "n", "name"]
        kinds = [pa.binary(16), pa.int32(), pa.int8(), pa.int64(), pa.binary()]
        for batch in batches:
            for word, n, name in zip(*(c.to_pylist() for c in batch.columns)):
                letters = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64)
                codes = [_front_codes(letters, prime, base) for prime, base in CODES]
                fronts = np.stack([np.concatenate(c) for c in codes], axis=1).astype("<u4")
                first = np.append(True, letters[1:] != letters[:-1])
                mark = np.append(np.full(len(letters) + 1, WHOLE), np.where(first, WITH_FIRST, WITH)).astype(np.int8)
                letter = np.append(np.zeros(len(letters) + 1, np.int32), letters.astype(np.int32))
                # The longest words that are spelt out meet longer ones here, and each other there.
                total = len(mark) if len(letters) > SPELT else len(letters) + 1
                for a in range(0, total, ROWS):
                    b = min(a + ROWS, total)
                    front = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), b - a, [None, pa.py_buffer(fronts[a:b].tobytes())])
                    yield batch_of(names, [front.cast(pa.binary()), letter[a:b], mark[a:b], [n] * (b - a), [name] * (b - a)], [pa.binary(), *kinds[1:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _grouped(batches):
            if rows.num_rows:
                n, name = rows.column(3).to_numpy(), rows.column(4)
                who, near, best = _links(n, rows.column(2).to_numpy(), starts)
                yield batch_of(LINKS, [name.take(pa.array(who)), near, n[best], name.take(pa.array(best))], [pa.binary(), pa.int64(), pa.int64(), pa.binary()])

    turned = named.mapInArrow(turn, "front binary, letter int, mark tinyint, n bigint, name binary")
    dealt = turned.repartition("front").sortWithinPartitions("front", F.desc("n"), "letter")
    links = dealt.mapInArrow(scan, "word binary, near bigint, best_n bigint, best binary")
    spelt = named.select("name", F.col("word").alias("spelt"))
    whole = links.join(spelt, links["word"] == spelt["name"]).select(F.col("spelt").alias("word"), "near", "best_n", F.col("best").alias("name"))
    return whole.join(spelt, "name").select("word", "near", "best_n", F.col("spelt").alias("best"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of words with any, how many and the struct (less, word) of the most frequent.

    ``less`` is the number of its occurrences with a minus, so the least struct is the best one.
    """
    links = _short_links(words.where(F.length("word") <= SPELT)).union(_long_links(words.where(F.length("word") >= SPELT)))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return links.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))


def _roots(space: Workspace, forms: DataFrame, most: int) -> DataFrame:
    """(word, root) from (word, form): each join doubles the way up.

    A form is ``FORM_TIMES`` as frequent as its word, so chains are as short as a logarithm.
    """
    longest = math.log(max(most / LEAST_TIMES, 1), FORM_TIMES)
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        roots = space.put(roots.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root")))
    return roots


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all long words that occur twice or more (starts jobs).

    The form is the most frequent word that is one character away, if it is ``FORM_TIMES`` as
    frequent or more; the root is the last one on the way from form to form.
    """
    space = Workspace(docs.sparkSession)
    words = space.put(counted(occurrences(docs)))
    is_form = -F.col("best.less") >= FORM_TIMES * F.col("n")
    judged = words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    judged = space.put(judged)
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(space, judged.where("form is not null"), most)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
