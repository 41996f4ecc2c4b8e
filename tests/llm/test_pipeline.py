"""The pipeline's stages on hard rows, against plain Python."""

import hashlib
import random
import re
import struct
from itertools import combinations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from revlens.llm import secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["_revlens_key", "_revlens_text_key", "text_key", "row", "stats", "own_text", "group_id", "n", "id_0", "key_0", "a.b"]


def words(text):
    return WORD.findall(text or "")


def prose(pick, n):
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def items():
    pick = random.Random(7)
    return [(i, prose(pick, 30 + 5 * i)) for i in range(4)]


@pytest.fixture(scope="module")
def rows(items):
    """Good and bad texts, exact and near copies, passages of the benchmark, secrets, odd rows."""
    pick = random.Random(3)
    base = [prose(pick, pick.randint(80, 200)) for _ in range(60)]
    texts = list(base)
    for text in base[:15]:
        parts = text.split(" ")
        parts[pick.randrange(len(parts))] = "changed"
        texts += [" ".join(parts), text.upper(), text + " tail"]
    texts += [f"{prose(pick, 60)} {item} {prose(pick, 60)}" for _, item in items]
    texts += [prose(pick, 70) + " password = hunter2Xyz99 " + prose(pick, 30), prose(pick, 90) + " AKIA" + "Q7" * 9]
    texts += ["", None, "few words only", "spam " * 300, base[0], base[0], prose(pick, 60_000)]
    made = [(i if i % 23 else None, t) for i, t in enumerate(texts)]
    return [*made, made[3], made[3], (5, base[5])]


def frame(spark, rows):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    return docs.withColumns({name: F.lit("clash") for name in CLASHING if "." not in name}).withColumn("a.b", F.lit(1)).repartition(4)


@pytest.fixture(scope="module")
def folder(spark, rows, items, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    frame(spark, rows).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    labels = [(d, int(len(words(t)) >= 60), 0) for d, t in rows if d is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def shingles(text):
    found = words(text.translate(secret_table()) if text else "")
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def secret_table():
    return str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def without_copies(rows):
    """One row of each group of near duplicates: the smallest id, NULL last."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        same = (rows[i] == rows[j]) or (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
        if same:
            parent[root(j)] = root(i)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root(i), []).append(row)
    return groups


def test_quality_keeps_clean_rows_and_all_columns(spark, rows, folder):
    docs = frame(spark, rows)
    kept = pipeline.quality_rules(spark, docs, folder)
    assert kept.columns == docs.columns
    left = pairs(kept)
    assert set(left) <= set(rows)
    assert not any(len(words(t)) < 50 or t == "spam " * 300 for _, t in left)
    assert len(left) >= 0.95 * sum(len(words(t)) >= 60 and not (t or "").startswith("spam") for _, t in rows)


def test_one_document_of_each_group_stays(spark, rows, folder):
    docs = frame(spark, rows)
    kept = pipeline.near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    left, groups = pairs(kept), without_copies(rows)
    assert len(left) == len(groups)
    for group in groups.values():
        best = min(group, key=lambda r: (r[0] is None, r[0] or 0))
        mine = [r for r in left if r in group and (r[0] == best[0])]
        assert mine, group[0]


def test_benchmark_passages_go_and_others_stay(spark, rows, items, folder):
    docs = frame(spark, rows)
    kept = pipeline.benchmark_decontamination(spark, docs, folder)
    assert kept.columns == docs.columns
    assert pairs(kept) == sorted((r for r in rows if not any(item in (r[1] or "") for _, item in items)), key=repr)


def test_secrets_are_marked(spark, rows, folder):
    docs = frame(spark, rows)
    clean = pipeline.secret_scans(spark, docs, folder)
    assert clean.columns == docs.columns
    assert pairs(clean) == sorted(((d, secret_scan.redacted(t)) for d, t in rows), key=repr)
    assert not any("hunter2" in (t or "") or "AKIA" in (t or "") for _, t in pairs(clean))
    assert all(r.n_chars == len(r.text) for r in clean.where("text is not null").collect())


def test_encoding_equals_the_library(spark, rows, folder):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    got = [tuple(r) for r in pipeline.bpe_encoding(spark, frame(spark, rows), folder).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_stages_follow_each_other(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect() or [], stage(spark, docs, folder).schema)
    assert sorted(map(tuple, pipeline.run(spark, folder).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert pipeline.near_duplicates(spark, frame(spark, []), folder).count() == 0
