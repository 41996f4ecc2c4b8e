"""Spelling variants against pairs found one by one."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    small, large = sorted((a, b), key=len)
    return any(large[:i] + large[i + 1 :] == small for i in range(len(large)))


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    found = {w: sorted((-words[v], v) for v in words if near(w, v)) for w in words}
    form = {w: f[0][1] if f and -f[0][0] >= 10 * words[w] else None for w, f in found.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), words[w], len(found[w]), words[form[w]] if form[w] else None) for w in words}


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r.word: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_all_pairs(docs_of, seed):
    pick = random.Random(seed)
    bases = ["aaaaaaa", "aaaaaaaa", "Abababab", "Àà÷×ÿtreed", "commonly", "commonl", "mississippi"]

    def word():
        w = pick.choice(bases)
        for _ in range(pick.choice([0, 0, 1, 1, 2])):
            i, c = pick.randrange(len(w)), pick.choice("abxéÉZ")
            w = pick.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
        return w

    vocabulary = [word() for _ in range(150)] + bases
    weights = [pick.choice([1, 1, 10, 100]) for _ in vocabulary]
    rows = [(pick.choice([i, i, None]), pick.choice([" ", "-", "1 ", "\n"]).join(pick.choices(vocabulary, weights, k=60))) for i in range(120)]
    rows += [(5, None), (6, ""), (7, "short"), rows[0], rows[0]]
    assert result(spelling.variants(docs_of(rows))) == brute(rows)


def test_roots_at_the_end_of_long_chains(docs_of):
    chain = ["chaining", "chaininh", "chaininhx", "chaininx", "chaininxy"]
    doc = next(d for d in range(1000) if all(zlib.crc32(f"{d}:{w}".encode()) % 31 for w in chain))
    rows = [(doc, f"{word} " * (2 * 10**k)) for k, word in enumerate(chain)]
    got = result(spelling.variants(docs_of(rows)))
    assert got == brute(rows)
    assert {v[1] for v in got.values()} == {"chaininxy"}


def test_long_words_meet_like_short_ones(docs_of):
    base = "abcdefghij" * 7
    words = [base[:k] for k in range(62, 68)]
    words += [w[:i] + c + w[i + 1 :] for w in words for i in (0, 30, len(w) - 1) for c in "xy"] + [w[:9] + w[8:] for w in words] + ["a" * 80, "a" * 81, "a" * 82]
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choices(words, [1 + 30 * (i % 7 == 0) for i in range(len(words))], k=50))) for i in range(60)]
    got = result(spelling.variants(docs_of(rows)))
    assert got == brute(rows)
    assert any(v[0] and len(w) > 64 for w, v in got.items())


def test_groups_over_many_batches(spark, docs_of):
    rows = [(i, " ".join(f"pattern{chr(97 + i % 26)}{chr(97 + j)} pattern{chr(97 + j)}" for j in range(26))) for i in range(80)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(spelling.variants(docs_of(rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_long_text_and_no_words(docs_of):
    assert result(spelling.variants(docs_of([]))) == {}
    assert result(spelling.variants(docs_of([(1, "few short ones"), (None, None)]))) == {}
    text = "x" * 300_000 + " verylong" * 100_000 + " verylonh" * 5000
    got = result(spelling.variants(docs_of([(1, text), (2, text)])))
    assert got == brute([(1, text), (2, text)])
    assert any(len(word) >= 299_999 for word in got)


def test_groups_are_small_however_hot_a_word_is(spark):
    words = spark.range(3000).select(F.concat(F.lit("hotword"), F.col("id").cast("string")).alias("word"), F.lit(5).cast("bigint").alias("n"))
    sizes = spelling.rotations(words).groupBy("front").count()
    assert sizes.agg(F.max("count")).first()[0] <= 11
