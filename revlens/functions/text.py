"""Lengths, labels and the tokens of a review text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pieces removed from a lower-cased text, in this order. The order
# matters: what is left of "<br /><br />" is "<br", "" and ">".
REMOVED_PIECES = (".", "><br", "/", "-")

# Tokens that are never words.
JUNK_TOKENS = ("", ">")

# The default stop words.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "is", "are", "was", "were", "in", "on", "at",
    "to", "for", "of", "with", "by", "from", "as", "this", "that", "it", "be", "have",
    "has", "had", "do", "does", "did", "will", "would", "could", "should", "may",
    "might", "can",
)


def length_or_zero(text: Column) -> Column:
    """Number of characters (code points); 0 for a missing text."""
    return F.coalesce(F.length(text), F.lit(0))


def tokens(text: Column) -> Column:
    """Array of tokens: lower-cased, cleaned, cut at single spaces, empties kept."""
    cleaned = F.lower(text)
    for piece in REMOVED_PIECES:
        cleaned = F.replace(cleaned, F.lit(piece), F.lit(""))
    return F.split(cleaned, " ", -1)


def title_label(name: Column) -> Column:
    """``video_game`` becomes ``Video Game``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def percent_label(share: Column) -> Column:
    """A percentage with one decimal, such as ``12.5%``."""
    return F.format_string("%.1f%%", share)


def count_label(n: Column) -> Column:
    """A whole number with thousands separators, such as ``1,234,567``."""
    return F.format_number(n, 0)
