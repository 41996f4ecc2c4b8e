"""Statistics of an exact random sample, mostly over its verified reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.operators import summary
from revlens.operators.distribution import equal_width_histogram
from revlens.operators.sampling import sample_exact, sample_repeated
from revlens.operators.transform import verified_only
from revlens.session import materialise
from revlens.sources.jsonl import PLACE, not_blank, parse_strict, read_lines, with_defaults

SAMPLE_SIZE = 5000
SEED = 42


def sampled_records(
    spark: SparkSession, path: str | list[str], n: int = SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """``n`` random records of JSON-lines files, with defaults filled in (starts jobs).

    Lines are drawn by file and text, so only the drawn lines are ever parsed, and the draw
    does not depend on how files are split. Blank lines are no records and left out before.
    """
    lines = sample_repeated(not_blank(read_lines(spark, path)), n, PLACE, seed)
    return with_defaults(parse_strict(lines), keep=["file", *PLACE])


def describe(sample: DataFrame) -> dict[str, DataFrame]:
    """All reports of a sample, which is stored once and read by each (starts a job)."""
    sample = materialise(sample)
    verified = verified_only(sample)
    by_votes = summary.rating_by_votes(verified)
    return {
        "rating_stats": summary.rating_stats(verified),
        "rating_by_votes": by_votes.orderBy("helpful_vote"),
        "rating_by_few_votes": summary.votes_up_to(by_votes).orderBy("helpful_vote"),
        "good": summary.split_counts(verified, summary.is_good(), "is_good").orderBy("is_good"),
        "good_share": summary.good_share(verified),
        "bad": summary.split_counts(verified, summary.is_bad(), "is_bad").orderBy("is_bad"),
        "bad_of_all": summary.split_counts(sample, summary.is_bad(), "is_bad").orderBy("is_bad"),
        "average_length": summary.average_length(verified),
        "length_by_rating": summary.length_by_rating(verified).orderBy("rating"),
        "rating_histogram": equal_width_histogram(verified).orderBy("bin"),
    }


def describe_sample(
    reviews: DataFrame, keys: list[str], n: int = SAMPLE_SIZE, seed: int = SEED
) -> dict[str, DataFrame]:
    """All reports over ``n`` reviews of a table, drawn by ``keys`` (starts jobs)."""
    return describe(sample_exact(reviews, n, keys, seed))
