"""Run the analyses on JSON-lines files and write every report as CSV.

    spark-submit --py-files revlens.zip revlens/plans/run.py --out OUT \\
        --compare book=BOOKS.jsonl --compare video_game=GAMES.jsonl \\
        --sample FILE --texts FILE --stop-words WORDS.txt --trend FILE \\
        --calibrate book=BOOKS.jsonl --calibrate video_game=GAMES.jsonl --min-reviews 3 \\
        --first-lines 5000 FILE --random-lines 50000 FILE

Each option may be left out. Reports go to ``OUT/<analysis>_<UTC time>/<report>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import STOP_WORDS
from revlens.operators.calibrate import MIN_REVIEWS_PER_USER, MORE_THAN_PER_PRODUCT
from revlens.operators.transform import labelled
from revlens.plans.calibration import describe_calibration
from revlens.plans.category_comparison import compare
from revlens.plans.line_samples import save_first_lines, save_random_lines
from revlens.plans.sample_statistics import SAMPLE_SIZE, SEED, describe, sampled_records
from revlens.plans.star_texts import describe_texts
from revlens.plans.trends import describe_trend
from revlens.schema import REVIEW_FIELDS
from revlens.session import build_session, remove_stored
from revlens.sources.csv import stamped_path, write_csv
from revlens.sources.jsonl import read_lenient, read_strict

# The only fields that calibration needs, so the only ones that are parsed.
CALIBRATION_FIELDS = {name: REVIEW_FIELDS[name] for name in ("user_id", "asin", "rating", "helpful_vote")}

# Reports that grow with the number of users, products or reviews keep many files.
_MANY_FILES = {"user_stats", "calibrated_reviews", "product_delta"}


def stop_words_of(spark: SparkSession, path: str) -> DataFrame:
    """The stop words of a text file with one word a line."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).filter("word <> ''")


def calibration_input(spark: SparkSession, named: Sequence[str]) -> DataFrame:
    """The fields that calibration needs of all files, ``PATH`` or ``CATEGORY=PATH``."""
    parts = []
    for given in named:
        category, equals, path = given.partition("=")
        if not equals or "/" in category:
            parts.append(read_lenient(spark, given, CALIBRATION_FIELDS))
        else:
            parts.append(labelled(read_lenient(spark, path, CALIBRATION_FIELDS), category))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def analyses(spark: SparkSession, args: argparse.Namespace) -> dict[str, dict[str, DataFrame]]:
    """The reports of every analysis that was asked for."""
    found: dict[str, dict[str, DataFrame]] = {}
    if args.compare:
        named = dict(pair.split("=", 1) for pair in args.compare)
        found["compare"] = compare({name: read_strict(spark, path) for name, path in named.items()})
    if args.sample:
        found["sample"] = describe(sampled_records(spark, args.sample, args.sample_size, args.seed))
    if args.texts:
        stop_words = stop_words_of(spark, args.stop_words) if args.stop_words else STOP_WORDS
        found["texts"] = describe_texts(read_strict(spark, args.texts), args.top_words, stop_words)
    if args.trend:
        found["trend"] = describe_trend(read_strict(spark, args.trend))
    if args.calibrate:
        reviews = calibration_input(spark, args.calibrate)
        found["calibrate"] = describe_calibration(reviews, args.min_reviews, args.more_than, args.top_delta)
    return found


def save(reports: dict[str, DataFrame], folder: str) -> None:
    """Write every report under ``folder``, refusing to overwrite (starts jobs)."""
    for name, table in reports.items():
        write_csv(table, f"{folder}/{name}", mode="errorifexists", one_file=name not in _MANY_FILES)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--out", required=True)
    parser.add_argument("--compare", action="append", default=[], metavar="CATEGORY=PATH")
    parser.add_argument("--sample", metavar="PATH")
    parser.add_argument("--sample-size", type=int, default=SAMPLE_SIZE)
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--texts", metavar="PATH")
    parser.add_argument("--stop-words", metavar="PATH")
    parser.add_argument("--top-words", type=int, default=10)
    parser.add_argument("--trend", metavar="PATH")
    parser.add_argument("--calibrate", action="append", default=[], metavar="[CATEGORY=]PATH")
    parser.add_argument("--min-reviews", type=int, default=MIN_REVIEWS_PER_USER)
    parser.add_argument("--more-than", type=int, default=MORE_THAN_PER_PRODUCT)
    parser.add_argument("--top-delta", type=int, default=30)
    parser.add_argument("--first-lines", nargs=2, metavar=("N", "PATH"))
    parser.add_argument("--random-lines", nargs=2, metavar=("N", "PATH"))
    args = parser.parse_args(argv)
    spark = build_session("review-analyses")
    for name, reports in analyses(spark, args).items():
        save(reports, stamped_path(args.out, name))
    if args.first_lines:
        n, path = args.first_lines
        save_first_lines(spark, path, stamped_path(args.out, "first_lines"), int(n))
    if args.random_lines:
        n, path = args.random_lines
        save_random_lines(spark, path, stamped_path(args.out, "random_lines"), int(n), args.seed)
    remove_stored()


if __name__ == "__main__":
    main()
