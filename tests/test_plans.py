"""The complete analyses on small files."""

import json
import random
from pathlib import Path

import pytest

from revlens.operators import calibrate, distribution, summary, trend, words
from revlens.operators.transform import union_labelled
from revlens.plans import run
from revlens.plans.calibration import describe_calibration
from revlens.plans.category_comparison import compare
from revlens.plans.line_samples import save_random_lines
from revlens.plans.sample_statistics import describe_sample, sampled_records
from revlens.plans.star_texts import describe_texts
from revlens.plans.trends import describe_trend, save_yearly
from revlens.session import shared_folder
from revlens.sources.csv import read_csv
from revlens.sources.jsonl import read_lenient, read_strict


def records(seed, n):
    generator = random.Random(seed)
    for i in range(n):
        yield {
            "rating": float(generator.randint(0, 5)),
            "title": "t" * generator.randrange(5),
            "text": " ".join(generator.choices(["great", "bad", "the", "Fine.", "well-made"], k=generator.randrange(9))),
            "images": [{"u": j} for j in range(generator.randrange(3))],
            "asin": f"A{generator.randrange(20)}",
            "parent_asin": "P",
            "user_id": f"U{generator.randrange(40)}",
            "timestamp": 900_000_000_000 + generator.randrange(10**12),
            "helpful_vote": generator.randrange(30),
            "verified_purchase": generator.random() < 0.7,
        }


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("reviews")
    paths = {}
    for seed, name in enumerate(["book", "video_game"]):
        path = folder / f"{name}.jsonl"
        path.write_text("".join(json.dumps(r) + "\n" for r in records(seed, 400 + 37 * seed)))
        paths[name] = str(path)
    return paths


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, right.collect()), key=repr)


def test_comparison_from_one_pass_equals_separate_reports(spark, files):
    by_category = {name: read_strict(spark, path) for name, path in files.items()}
    reviews = union_labelled(by_category)
    reports = compare(by_category)
    same(reports["summary"], summary.category_summary(reviews))
    same(reports["ratings"], distribution.rating_pivot(reviews, ["book", "video_game"]))
    same(reports["length_quartiles"], distribution.length_quartiles(reviews))
    same(reports["helpfulness"], summary.helpful_by_category(reviews))
    same(reports["verified"], summary.verified_by_category(reviews))
    totals = {r.category: r.total_reviews for r in reports["summary"].collect()}
    assert totals == {"book": 400, "video_game": 437}
    ratings = reports["ratings"].collect()
    assert sum(r.book for r in ratings) == 400
    assert sum(r.video_game for r in ratings) == 437
    for row in reports["length_quartiles"].collect():
        assert list(tuple(row)[1:]) == sorted(tuple(row)[1:])


def test_sample_reports_agree_with_each_other(spark, files):
    reviews = read_strict(spark, files["book"])
    reports = describe_sample(reviews, ["user_id", "asin", "timestamp"], 200)
    n = reports["rating_stats"].first().n
    assert sum(r.n for r in reports["good"].collect()) == n
    assert sum(r.n for r in reports["bad"].collect()) == n
    assert sum(r.n for r in reports["bad_of_all"].collect()) == 200
    assert sum(r.n for r in reports["rating_by_votes"].collect()) == n
    assert sum(r.n for r in reports["rating_histogram"].collect()) == n
    share = reports["good_share"].first()
    assert share.good + share.not_good == n
    assert share.good_percent + share.not_good_percent == pytest.approx(100)
    assert reports["average_length"].first().n == n
    assert {r.helpful_vote for r in reports["rating_by_few_votes"].collect()} <= set(range(21))


def test_random_lines_keep_the_input_order(spark, tmp_path):
    path = tmp_path / "lines.jsonl"
    source = [json.dumps({"i": i, "same": True}) if i % 3 else "{}" for i in range(20_000)]
    path.write_text("\n".join(source) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        save_random_lines(spark, str(path), str(tmp_path / "out"), 3000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    got = [line for p in parts for line in p.read_text().splitlines()]
    assert len(got) == 3000
    numbers = [json.loads(line)["i"] for line in got if line != "{}"]
    assert numbers == sorted(set(numbers))
    assert 800 < got.count("{}") < 1200


def test_sampled_records_fill_in_defaults(spark, tmp_path):
    path = tmp_path / "few.jsonl"
    path.write_text('{"rating": 4.5, "images": [{"u": 1}]}\n{"text": "abc", "verified_purchase": true}\n')
    got = {r.row: r for r in sampled_records(spark, str(path), 2).collect()}
    first, second = got[0], got[1]
    assert (first.rating, first.image_count, first.verified_purchase, first.text) == (4.5, 1, False, "")
    assert (second.rating, second.image_count, second.verified_purchase, second.text) == (0.0, 0, True, "abc")


def test_strict_sample_fails_on_a_bad_line(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"rating": 4.5}\nnot json\n')
    with pytest.raises(Exception):
        sampled_records(spark, str(path), 2).collect()


def test_texts(spark, files):
    reviews = read_strict(spark, files["book"])
    reports = describe_texts(reviews, k=2)
    same(reports["top_words"], words.top_words(reviews, 2))
    same(reports["length_by_star"], summary.length_by_star(reviews))
    shares = {}
    for row in reports["top_words"].collect():
        shares[row.star] = shares.get(row.star, 0) + row.freq
    assert set(shares) == {1, 2, 3, 4, 5}
    assert all(share <= 1.0001 for share in shares.values())


def test_trend_reports_and_csv(spark, files, tmp_path):
    reviews = read_strict(spark, files["book"])
    reports = describe_trend(reviews)
    same(reports["yearly"], trend.yearly(reviews))
    assert reports["total"].first()[0] == 400
    save_yearly(reviews, str(tmp_path / "yearly"))
    same(read_csv(spark, str(tmp_path / "yearly")), trend.yearly(reviews))


def test_calibration_reports(spark, files):
    reviews = read_lenient(spark, files["video_game"])
    reports = describe_calibration(reviews)
    same(reports["product_delta"], calibrate.product_delta(reviews))
    same(reports["calibrated_reviews"], calibrate.calibrate(reviews))
    same(reports["user_stats"], summary.user_stats(reviews))
    assert reports["top_delta"].count() == min(30, reports["product_delta"].count())


def test_calibration_of_two_labelled_files(spark, files):
    named = [f"{name}={path}" for name, path in files.items()]
    reviews = run.calibration_input(spark, named)
    assert set(reviews.columns) == {"user_id", "asin", "rating", "helpful_vote", "category"}
    counts = {r.category: r["count"] for r in reviews.groupBy("category").count().collect()}
    assert counts == {"book": 400, "video_game": 437}
    assert "category" not in run.calibration_input(spark, [files["book"]]).columns
    strict = describe_calibration(reviews, min_reviews=25, more_than=30, k=5)
    assert strict["product_delta"].filter("count <= 30").isEmpty()
    kept = strict["calibrated_reviews"].groupBy("user_id").count()
    assert kept.count() > 0 and kept.filter("count < 25").isEmpty()


def test_command_line(spark, files, tmp_path):
    out = tmp_path / "out"
    stop_words = tmp_path / "words.txt"
    stop_words.write_text("great\n\n The\n")
    run.main(
        ["--out", str(out), "--compare", f"book={files['book']}", "--compare",
         f"video_game={files['video_game']}", "--sample", files["book"], "--sample-size", "50",
         "--texts", files["book"], "--stop-words", str(stop_words), "--trend", files["book"],
         "--calibrate", f"video_game={files['video_game']}", "--calibrate", f"book={files['book']}",
         "--min-reviews", "2", "--more-than", "3", "--top-delta", "4",
         "--first-lines", "7", files["book"], "--random-lines", "9", files["book"]]
    )
    folders = {p.name.rsplit("_", 2)[0]: p for p in out.iterdir()}
    analyses = {"compare", "sample", "texts", "trend", "calibrate"}
    assert set(folders) == analyses | {"first_lines", "random_lines"}
    source = open(files["book"]).read().splitlines()
    assert [r.value for r in spark.read.text(str(folders["first_lines"])).collect()] == source[:7]
    assert spark.read.text(str(folders["random_lines"])).count() == 9
    assert (folders["calibrate"] / "calibrated_reviews" / "_SUCCESS").exists()
    assert spark.read.option("header", True).csv(str(folders["calibrate"] / "top_delta")).count() == 4
    top = spark.read.option("header", True).csv(str(folders["texts"] / "top_words")).collect()
    assert {r.word for r in top} == {"bad", "fine", "wellmade"}
    bands = spark.read.option("header", True).csv(str(folders["texts"] / "length_by_vote_band"))
    assert bands.count() == 5
    assert not list(Path(shared_folder(spark)).glob("revlens-*"))
    yearly = read_csv(spark, str(folders["trend"] / "yearly"))
    assert sum(r.num_ratings for r in yearly.collect()) == 400
    stats = spark.read.option("header", True).csv(str(folders["sample"] / "bad_of_all"))
    assert sum(int(r.n) for r in stats.collect()) == 50
