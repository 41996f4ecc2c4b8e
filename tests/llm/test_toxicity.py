"""The toxicity classifier: tokens, whole texts, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revlens.llm import queries, toxicity
from revlens.llm.store import Workspace


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else "÷" if c == "×" else c for c in text)


def test_words_and_beginnings_of_texts():
    texts = ["The THE the", "Été été", "über Übermut 日本語日本 x", None, "", "...", "a-b.c1", "été", "über", "überm"]
    words, rows = toxicity.buckets(pa.array(texts))
    names = [re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", fold(t or "")) for t in texts]
    assert np.diff(rows).tolist() == [len(n) for n in names]
    flat = [w for n in names for w in n]
    whole, begun = {}, {}
    for word, (a, b) in zip(flat, words.tolist()):
        assert whole.setdefault(word, a) == a
        assert begun.setdefault(word[:4], b) == b
    assert len(set(whole.values())) == len(whole) and len(set(begun.values())) == len(begun)


def test_blocks_do_not_change_scores(monkeypatch):
    pick = random.Random(3)
    texts = [" ".join(pick.choice("ab cd ef gh ij kl".split()) for _ in range(pick.choice([0, 1, 2, 3, 50, 400]))) for _ in range(60)]
    model = toxicity.Model.fresh(np.random.default_rng(1)).in_steps()
    words, rows = toxicity.buckets(pa.array(texts))
    expected = model.margins(words, rows)
    one = [model.margins(*toxicity.buckets(pa.array([t])))[0] for t in texts]
    assert expected.tolist() == one
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert model.margins(words, rows).tolist() == expected.tolist()
    pooled, where = model.pooled(words, rows, places=True)
    assert np.array_equal(pooled, model.pooled(words, rows)[0])
    assert (where.min(axis=1)[1:] >= where.min(axis=1)[:-1]).all()


def test_gradients_lower_the_loss():
    good, bad = (toxicity.buckets(pa.array([t]))[0] for t in ("one two three four", "one two nasty four"))
    model = toxicity.fit([good, bad] * 20, np.array([0.0, 1.0] * 20), steps=60)
    margins = model.margins(np.concatenate([good, bad]), np.array([0, 4, 8]))
    assert margins[0] < -1 and margins[1] > 1


def test_threshold_balances():
    margins, toxic = np.array([3.0, 2.0, 1.0, -1.0, -2.0]), np.array([1.0, 1.0, 0.0, 1.0, 0.0])
    assert toxicity.best_threshold(margins, toxic, np.ones(5)) == -1.5
    assert toxicity.best_threshold(margins, toxic, np.array([1, 1, 9, 1, 9.0])) == 1.5


def test_language_by_function_words():
    texts = ["the cat of it", "der Hund und das", "le chat et les", "los perros y el", "xyz", None]
    found = toxicity.languages(*toxicity.buckets(pa.array(texts)))
    assert [toxicity.LANGUAGES[i] for i in found] == ["en", "de", "fr", "es", "", ""]


@pytest.fixture(scope="module")
def labelled(spark):
    """Invented words; every eighth text has insulting words, long texts one of them."""
    pick = random.Random(8)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 8 == 0
        text = ["".join(pick.choice(["la", "to", "mi", "ren", "su"]) for _ in range(pick.randint(1, 4))) for _ in range(pick.choice([20, 60, 300, 3000]) if i % 50 == 0 else 40)]
        text[5] = "the"
        for _ in range(2 * bad):
            text[pick.randrange(len(text))] = pick.choice(["insult", "Scoundrel!", "rottenest"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (3, 1, None), (99_999, 0, 1)]
    return rows, labels


def test_held_out_rows(spark, docs_of, labelled):
    rows, labels = labelled
    odd = [(None, "insult scoundrel"), (5000, None), (5001, ""), (5002, ". , !"), (5003, "mila " * 200_000 + "insult"), (1, rows[1][1]), (1, rows[1][1])]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = docs_of(rows + odd).withColumns({"order": F.lit("o"), "toxic": F.lit(2), "id": F.lit(0)})
    got = toxicity.judged(docs, frame).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [i for i, _ in rows if by_id[i].held_out]
    wrong = [i for i in held if by_id[i].predicted != (i % 8 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert by_id[5003].predicted == 1 and by_id[None].predicted == 1
    assert len({by_id[i].score for i in (5000, 5001, 5002)}) == 1 and by_id[5000].predicted == 0
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_held_out_labels_are_not_learned(spark, docs_of, labelled):
    rows, labels = labelled
    flipped = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    a, b = (toxicity.learn(docs_of(rows), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert np.array_equal(a.words, b.words) and np.array_equal(a.thresholds, b.thresholds)


def test_nothing_to_learn_from(spark, docs_of):
    schema = "doc_id bigint, quality int, toxic int"
    for labels in ([], [(1, 1, 0), (2, 1, 0), (3, 0, 0)]):
        got = toxicity.judged(docs_of([(1, "a"), (2, "b"), (3, "c")]), spark.createDataFrame(labels, schema)).collect()
        assert [r.score for r in got] == [0.0] * 3
    assert toxicity.judged(docs_of([]), spark.createDataFrame([], schema)).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op12_toxicity"](spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r.toxic for r in labels)
    assert len(got) == 10_000 and right >= 0.97 * len(labels)


def test_every_labelled_text_is_used(spark, docs_of):
    rows = [(i, f"w{i} x") for i in range(12_000)] + [(1, "w1 x"), (2, "other"), (None, "n")]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(0, 12_000, 2)] + [(4, 1, 1), (6, 1, None)], "doc_id bigint, quality int, toxic int")
    found, shards = toxicity._labelled(Workspace(spark), docs_of(rows), labels)
    known = [i for i in range(0, 12_000, 2) if zlib.crc32(str(i).encode()) % 5]
    expected = len(known) + 1  # doc 2 has two texts
    assert zlib.crc32(b"2") % 5 and shards == 1 and found.count() == expected > 4500
    assert found.agg(F.sum("toxic")).first()[0] == sum(i % 3 == 0 or i == 4 for i in known)


def test_thresholds_of_all_rows(spark):
    pick = random.Random(4)
    rows = [(pick.choice([0, 1, 2]), pick.choice([pick.gauss(0, 1), 0.5, 0.25, 99.0, 100.0]), int(pick.random() < 0.2)) for _ in range(600)]
    rows += [(4, 1.0, 1), (4, -90.0, 1), (3, 7.0, 0)]
    found = toxicity.thresholds(Workspace(spark), spark.createDataFrame(rows, "language int, margin double, toxic int"))
    language, margins, toxic = (np.array(c) for c in zip(*rows))
    overall = toxicity.best_threshold(margins, toxic, np.ones(len(rows)))
    for k in range(5):
        mine, n = language == k, toxic[language == k].sum()
        own = toxicity.best_threshold(margins[mine], toxic[mine], np.ones(mine.sum())) if k < 3 else overall
        assert found[k] == pytest.approx((n * own + 20 * overall) / (n + 20))
    assert not toxicity.thresholds(Workspace(spark), spark.createDataFrame([(0, 1.0, 1)], "language int, margin double, toxic int")).any()


def test_learners_of_many_shards(spark, docs_of, labelled, monkeypatch):
    rows, labels = labelled
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 60_000)
    assert toxicity._labelled(Workspace(spark), docs_of(rows), frame)[1] > 3
    got = toxicity.judged(docs_of(rows), frame).where("held_out").collect()
    assert sum(r.predicted != (r.doc_id % 8 == 0) for r in got) <= 0.02 * len(got)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        again = toxicity.learn(docs_of(rows).repartition(7), frame)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    same = toxicity.learn(docs_of(rows), frame)
    assert np.array_equal(again.words, same.words) and np.array_equal(again.thresholds, same.thresholds)
