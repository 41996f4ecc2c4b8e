"""Operators against hand-worked cases and plain-Python brute force."""

import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date

import numpy
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.functions.numbers import round_half_up
from revlens.functions.text import title_label
from revlens.operators import calibrate, distribution, summary, transform, trend, words


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def half_up(x, digits):
    return math.floor(x * 10**digits + 0.5) / 10**digits


# Numbers ---------------------------------------------------------------------------


def test_rounding_goes_up_at_ties(spark):
    values = [1.025, 1.075, 1.275, 0.125, 2.0, 4.444, 4.446]
    df = frame(spark, [(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_up(F.col("v"), 2)).collect()]
    assert got == [half_up(v, 2) for v in values]


def test_rating_stats_are_population_and_skip_nulls(spark):
    ratings = [5.0, 4.0, 4.5, 1.0, None]
    row = summary.rating_stats(frame(spark, [(r,) for r in ratings], "rating double")).first()
    known = [r for r in ratings if r is not None]
    assert row.n == 4
    assert row.avg_rating == pytest.approx(statistics.fmean(known), abs=1e-12)
    assert row.stddev_rating == pytest.approx(statistics.pstdev(known), abs=1e-12)
    assert (row.min_rating, row.max_rating) == (1.0, 5.0)


def test_rating_stats_of_nothing(spark):
    row = summary.rating_stats(frame(spark, [], "rating double")).first()
    assert tuple(row) == (0, None, None, None, None)


# Groups and splits -----------------------------------------------------------------


def test_splits_and_shares(spark):
    df = frame(spark, [(r,) for r in (5.0, 4.0, 3.9, 3.0, 2.9, None)], "rating double")
    good = {r.is_good: r.n for r in summary.split_counts(df, summary.is_good(), "is_good").collect()}
    bad = {r.is_bad: r.n for r in summary.split_counts(df, summary.is_bad(), "is_bad").collect()}
    assert good == {1: 2, 0: 3}
    assert bad == {1: 1, 0: 4}
    share = summary.good_share(df).first()
    assert (share.good, share.not_good, share.good_percent, share.not_good_percent) == (2, 3, 40.0, 60.0)
    only_bad = summary.good_share(frame(spark, [(1.0,)], "rating double")).first()
    assert (only_bad.good, only_bad.not_good) == (0, 1)


def test_pivot_keeps_rating_zero_and_stars_drop_it(spark):
    rows = [(0.0, "book", "ab"), (1.0, "book", "abcd"), (3.9, "video_game", "x"), (5.0, "book", None)]
    df = frame(spark, rows, "rating double, category string, text string")
    pivot = distribution.rating_pivot(df, ["book", "video_game"]).orderBy("rating").collect()
    assert [tuple(r) for r in pivot] == [(0.0, 1, 0), (1.0, 1, 0), (3.9, 0, 1), (5.0, 1, 0)]
    stars = {r.star: r.avg_length for r in summary.length_by_star(df).collect()}
    assert stars == {1: 4.0, 3: 1.0, 5: 0.0}


def test_verified_labels_and_union_of_different_columns(spark):
    a = frame(spark, [(1.0, True)], "rating double, verified_purchase boolean")
    b = frame(spark, [(2.0, 7)], "rating double, helpful_vote long")
    both = transform.union_labelled({"video_game": a, "book": b})
    got = sorted((r.category, r.rating, r.verified_purchase, r.helpful_vote) for r in both.collect())
    assert got == [("book", 2.0, None, 7), ("video_game", 1.0, True, None)]
    row = summary.verified_by_category(both).filter("category = 'book'").first()
    assert (row.total, row.verified, row.unverified, row.verified_percent) == (1, 0, 1, 0.0)
    assert both.select(title_label(F.col("category")).alias("l")).filter("l = 'Video Game'").count() == 1


def test_step_counts(spark):
    df = frame(spark, [(1,), (2,), (None,)], "v int")
    steps = transform.step_counts(df, {"all": F.lit(True), "known": F.col("v").isNotNull()})
    assert {r.step: r.n for r in steps.collect()} == {"all": 3, "known": 2}


def test_dated_and_rated(spark):
    df = frame(spark, [(1, 1.0), (None, 1.0), (1, None)], "timestamp long, rating double")
    assert transform.dated_and_rated(df).count() == 1


# Distributions ---------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 12, 101])
def test_quartiles_follow_the_index_rule(spark, n):
    generator = random.Random(n)
    lengths = [generator.randrange(12) for _ in range(n)]
    df = frame(spark, [("c", "x" * k) for k in lengths], "category string, text string")
    ordered = sorted(lengths)
    row = distribution.length_quartiles(df).first()
    expected = (ordered[0], ordered[n // 4], ordered[n // 2], ordered[3 * n // 4], ordered[-1])
    assert tuple(row)[1:] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), min_size=1, max_size=40))
def test_quartiles_by_group(spark, pairs):
    df = frame(spark, [(c, "y" * k) for c, k in pairs], "category string, text string")
    groups = defaultdict(list)
    for category, k in pairs:
        groups[category].append(k)
    got = {r.category: tuple(r)[1:] for r in distribution.length_quartiles(df).collect()}
    for category, values in groups.items():
        values.sort()
        n = len(values)
        assert got[category] == (values[0], values[n // 4], values[n // 2], values[3 * n // 4], values[-1])


def test_star_histogram_edges(spark):
    ratings = [0.0, 0.49, 0.5, 1.0, 1.49, 1.5, 4.5, 5.0, 5.5, 5.51, None]
    df = frame(spark, [(r,) for r in ratings], "rating double")
    got = {r.bin: (r.low, r.high, r.n) for r in distribution.rating_histogram(df).collect()}
    assert got == {1: (0.5, 1.5, 3), 2: (1.5, 2.5, 1), 3: (2.5, 3.5, 0), 4: (3.5, 4.5, 0), 5: (4.5, 5.5, 3)}


def test_equal_width_histogram(spark):
    ratings = [1.0, 1.79, 1.8, 2.6, 5.0, 5.0]
    df = frame(spark, [(r,) for r in ratings], "rating double")
    got = [r.n for r in distribution.equal_width_histogram(df).orderBy("bin").collect()]
    assert got == [2, 1, 1, 0, 2]


@pytest.mark.parametrize("seed", range(4))
def test_equal_width_histogram_like_numpy(spark, seed):
    generator = random.Random(seed)
    ratings = [generator.randrange(0, 51) / 10 for _ in range(300)]
    df = frame(spark, [(r,) for r in ratings], "rating double")
    got = distribution.equal_width_histogram(df).orderBy("bin").collect()
    counts, _ = numpy.histogram(ratings, bins=[r.low for r in got] + [got[-1].high])
    assert [r.n for r in got] == counts.tolist()
    assert (got[0].low, got[-1].high) == (min(ratings), max(ratings))


def test_equal_width_histogram_of_one_value(spark):
    df = frame(spark, [(4.0,)] * 3, "rating double")
    got = distribution.equal_width_histogram(df).orderBy("bin").collect()
    assert [r.n for r in got] == [0, 0, 3, 0, 0]
    assert (got[0].low, got[-1].high) == (3.5, 4.5)


def test_vote_bands_are_means_of_means(spark):
    rows = [(0, "a"), (0, "abc"), (19, "a" * 10), (20, "ab"), (80, "x"), (10_000_000, "zzz")]
    df = frame(spark, rows, "helpful_vote long, text string")
    got = {r.band: r.mean_of_means for r in distribution.length_by_vote_band(df).collect()}
    assert got == {"Low": 6.0, "Medium-low": 2.0, "Medium": None, "Medium-high": None, "High": 2.0}


# Trends ----------------------------------------------------------------------------


def test_trend_uses_utc_and_drops_nulls(spark):
    new_year = 946_684_800_000  # 2000-01-01T00:00:00Z
    rows = [(new_year, 5.0), (new_year - 1, 3.0), (new_year + 1, 4.0), (None, 1.0), (new_year, None), (-1, 2.0)]
    df = frame(spark, rows, "timestamp long, rating double")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        years = sorted(tuple(r) for r in trend.yearly(df).collect())
        months = sorted(trend.monthly(df).collect(), key=lambda m: m.label)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert years == [(1969, 2.0, 1), (1999, 3.0, 1), (2000, 4.5, 2)]
    assert [m.label for m in months] == ["1969-12", "1999-12", "2000-01"]
    assert months[-1].month_start == date(2000, 1, 1)
    assert sorted(tuple(r) for r in trend.yearly_of_months(trend.monthly(df)).collect()) == years
    assert trend.total(trend.yearly(df)).first()[0] == 4


# Words -----------------------------------------------------------------------------


def test_top_words_counted_by_hand(spark):
    rows = [
        (5.0, "Green lamp, green-ish"),
        (5.0, "GREEN lamp. green lamp"),
        (5.9, "the green"),
        (2.0, "a/b ><br c"),
        (2.0, "c  of"),
        (0.5, "green"),
        (6.0, "green"),
        (4.0, None),
        (3.0, "the of ."),
    ]
    got = words.top_words(frame(spark, rows, "rating double, text string"), k=3)
    found = {(r.star, r["rank"], r.word, r.n, r.freq) for r in got.collect()}
    # Star 5 has eight words: green four times, lamp twice, "lamp," and "greenish" once.
    expected = {(5, 1, "green", 4, 0.5), (5, 2, "lamp", 2, 0.25), (5, 3, "greenish", 1, 0.125)}
    # Star 2: "a/b" becomes "ab", "c" is there twice, and "of" is a stop word.
    expected |= {(2, 1, "c", 2, 0.66667), (2, 2, "ab", 1, 0.33333)}
    assert found == expected



def test_top_words_break_ties_by_word(spark):
    text = " ".join(f"tie{i:02d}" for i in range(15))
    got = words.top_words(frame(spark, [(3.0, text)], "rating double, text string")).collect()
    assert sorted(r.word for r in got) == [f"tie{i:02d}" for i in range(10)]


def test_stop_words_are_a_parameter(spark):
    df = frame(spark, [(3.0, "the cat")], "rating double, text string")
    assert [r.word for r in words.top_words(df, stop_words=["cat"]).collect()] == ["the"]


@pytest.mark.parametrize("buckets", [1, 3, 50, 4096])
def test_bounded_top_words_are_exact_for_any_hash(spark, buckets):
    r = random.Random(buckets)
    rows = [(r.choice([1, 2, 5]), f"w{int(r.paretovariate(0.7)) % 300}") for _ in range(3000)]
    rows += [(4, f"tie{i:02d}") for i in range(20)] + [(3, "only")]
    counts, totals = words.frequent_words(frame(spark, rows, "star int, word string"), 7, buckets)
    held = {(c.star, c.word): c.n for c in counts.collect()}
    every = Counter(rows)
    assert all(every[key] == n for key, n in held.items())
    assert {t.star: t.total for t in totals.collect()} == Counter(star for star, _ in rows)
    best = lambda found, star: sorted((-n, w) for (s, w), n in found.items() if s == star)[:7]
    assert all(best(held, star) == best(every, star) for star in range(1, 6))


def test_bounded_top_words_equal_the_counted_ones(spark):
    texts = [(3.0, "a/b b . c c"), (3.0, None), (None, "x"), (5.0, "the the"), (2.0, "")]
    df = frame(spark, texts, "rating double, text string")
    for reviews in (df, df.limit(0)):
        found = [sorted(map(tuple, words.top_words(reviews, 2, bounded=b).collect())) for b in (False, True)]
        assert found[0] == found[1]
    with pytest.raises(ValueError, match="list"):
        words.top_words(df, stop_words=frame(spark, [("a",)], "word string"), bounded=True)


def test_stop_words_of_a_table(spark):
    df = frame(spark, [(3.0, "the cat and the dog"), (4.0, "cat")], "rating double, text string")
    listed = frame(spark, [("cat",), ("and",), (None,)], "word string")
    got = words.top_words(df, stop_words=listed).collect()
    assert sorted((r.star, r.word, r.n, r.freq) for r in got) == [(3, "dog", 1, 0.33333), (3, "the", 2, 0.66667)]


# Calibration -----------------------------------------------------------------------


def brute_delta(rows, min_reviews, more_than):
    by_user, by_product = defaultdict(list), defaultdict(list)
    for user, product, rating in rows:
        by_user[user].append(rating)
        by_product[product].append((user, rating))
    found = {}
    for product, reviews in by_product.items():
        calibrated = []
        for user, rating in reviews:
            mine = by_user[user]
            if user is not None and len(mine) >= min_reviews:
                average = half_up(sum(mine) / len(mine), 2)
                calibrated.append(math.floor(max(1.0, min(5.0, rating + (3.0 - average))) * 100 + 0.5))
        if calibrated and len(reviews) > more_than:
            original = sum(r for _, r in reviews) / len(reviews)
            after = sum(calibrated) / len(calibrated) / 100
            found[product] = (original, after, after - original, len(reviews))
    return found


def test_product_delta_thresholds_and_brute_force(spark):
    generator = random.Random(3)
    rows = [
        (f"u{generator.randrange(60)}", f"p{generator.randrange(25)}", float(generator.randint(1, 5)))
        for _ in range(180)
    ] + [(None, "p0", 5.0), ("", "p1", 1.0)]
    df = frame(spark, rows, "user_id string, asin string, rating double")
    got = {r.asin: tuple(r)[1:] for r in calibrate.product_delta(df).collect()}
    assert got == brute_delta(rows, 3, 5)
    assert len({len([r for r in rows if r[1] == p]) for p in {r[1] for r in rows}} & {5, 6}) > 0
    strict = {r.asin: tuple(r)[1:] for r in calibrate.product_delta(df, 5, 10).collect()}
    assert strict == brute_delta(rows, 5, 10)
    top = calibrate.top_delta(calibrate.product_delta(df), 4).collect()
    best = sorted(got.items(), key=lambda item: (-abs(item[1][2]), item[0]))[:4]
    assert [r.asin for r in top] == [p for p, _ in sorted(best, key=lambda item: (item[1][0], item[0]))]


def test_calibrated_rating_is_clamped_and_keeps_fields(spark):
    rows = [("u", "p", 5.0, "t"), ("u", "q", 1.0, "t"), ("u", "r", 1.0, "t"), ("v", "p", 5.0, "t")]
    df = frame(spark, rows, "user_id string, asin string, rating double, text string")
    got = {r.asin: r for r in calibrate.calibrate(df).collect()}
    assert set(got) == {"p", "q", "r"}
    assert got["p"].calibrated_rating == 5.0
    assert got["q"].calibrated_rating == pytest.approx(1.0 + (3.0 - 2.33))
    assert got["q"].text == "t"
    loose = calibrate.calibrate(df, min_reviews=1)
    assert loose.count() == 4
    assert loose.filter("calibrated_rating < 1 OR calibrated_rating > 5").count() == 0


def test_null_rating_is_neither_counted_nor_calibrated(spark):
    rows = [("u", "p", 4.0), ("u", "p", 4.0), ("u", "p", 4.0), ("u", "q", None)]
    df = frame(spark, rows, "user_id string, asin string, rating double")
    averages = calibrate.user_averages(df).first()
    assert (averages.user_avg, averages.user_reviews) == (4.0, 3)
    got = {r.asin: r.calibrated_rating for r in calibrate.calibrate(df).filter("asin = 'q'").collect()}
    assert got == {"q": None}


def test_user_stats(spark):
    rows = [("u", 5.0, 1), ("u", 4.0, 2), ("v", 1.0, 9)]
    df = frame(spark, rows, "user_id string, rating double, helpful_vote long")
    got = [tuple(r) for r in summary.most_helpful_first(summary.user_stats(df)).collect()]
    assert got == [("v", 1.0, 9.0, 1), ("u", 4.5, 1.5, 2)]


def test_product_average_of_a_named_column(spark):
    df = frame(spark, [("p", 2.0), ("p", 3.0), ("q", None)], "asin string, other double")
    got = {r.asin: (r.avg_rating, r.n) for r in summary.product_average(df, "other").collect()}
    assert got == {"p": (2.5, 2), "q": (None, 0)}
