"""Quality rules learned from labelled documents as an ordered decision list.

Statistics of each text are plain Spark expressions. Sequential covering takes one rule after
the other: a conjunction of thresholds grows by the condition of the highest information gain
on two thirds of the labelled rows, is cut back to the prefix that does best on the other third,
and is taken if it is precise enough there; the rows that it covers leave. The list becomes one
conditional expression, rule after rule, so the verdict of all documents is a projection.

The rules are fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the smallest digest of
their id; everything else covers all documents. Labels with NULL or without a document are left
out, several labels of one id count as the lowest. Without labels, or if no rule is precise
enough, the list is empty and keeps everything. NULL or empty text has no words and fails the
base rule. Every row gets its own verdict, repeated ones too. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.native import let
from revlens.llm.store import Workspace

SAMPLE_ROWS = 20_000
MAX_RULES = 8
MAX_CONDITIONS = 3
CUTS = 24
PRECISION = 0.9
LEAST_COVERED = 5

# The characters that count as symbols, and what separates words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _occurrences(text: Column, characters: str) -> Column:
    rest = text
    for character in characters:
        rest = F.replace(rest, F.lit(character), F.lit(""))
    return F.length(text) - F.length(rest)


def _words(text: Column) -> Column:
    """As ``native.words``, by single characters, for which splitting needs no pattern."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def _span(places: Column) -> Column:
    """How many words the windows of three that begin at sorted places cover."""
    steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, s: total + s)


def _repeated(tokens: Column) -> Column:
    """How many words are in windows of three words that the text has twice or more.

    Few repeated windows are looked up one by one, many are found by sorting all windows.
    """

    def few(windows: Column, twice: Column) -> Column:
        places = F.filter(F.transform(windows, lambda w, i: F.when(F.array_contains(twice, w), i)), lambda p: p.isNotNull())
        return let(places, _span)

    def many(windows: Column) -> Column:
        def places(rows: Column) -> Column:
            code = lambda i: F.get(rows, i)["code"]
            same = lambda w, i: F.coalesce(code(i - 1) == w["code"], F.lit(False)) | F.coalesce(code(i + 1) == w["code"], F.lit(False))
            return let(F.sort_array(F.transform(F.filter(rows, same), lambda w: w["at"])), _span)

        return let(F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("code"), i.alias("at")))), places)

    def sorted_windows(windows: Column) -> Column:
        def repeated(ordered: Column) -> Column:
            twice = F.array_distinct(F.filter(ordered, lambda w, i: F.coalesce(F.get(ordered, i - 1) == w, F.lit(False))))
            return let(twice, lambda found: F.when(F.size(found) == 0, F.lit(0)).when(F.size(found) <= 16, few(windows, found)).otherwise(many(windows)))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(windows), repeated))

    codes = F.transform(F.sequence(F.lit(0), F.size(tokens) - 3), lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(F.size(tokens) >= 4, let(codes, sorted_windows)).otherwise(F.lit(0))


def statistics(text: Column) -> Column:
    """A struct of the counts that the rates are made of."""

    def of_words(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).alias("n_words"), F.length(F.array_join(tokens, "")).alias("word_chars"), _repeated(tokens).alias("n_repeat_words")
        )

    def of_lines(own: Column) -> Column:
        return F.struct(F.size(own).alias("n_lines"), (F.size(own) - F.size(F.array_distinct(own))).alias("n_dup_lines"))

    def of_text(text: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
        return F.struct(
            let(_words(text), of_words).alias("w"),
            let(lines, of_lines).alias("l"),
            _occurrences(text, SYMBOLS).alias("n_symbols"),
            _occurrences(text, "|").alias("n_bars"),
            _occurrences(text, "0123456789").alias("n_digits"),
            _occurrences(text, "!?").alias("n_calls"),
        )

    return let(F.coalesce(text, F.lit("")), of_text)


def described(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the struct ``stats``: the counts, and the rates by their names."""
    raw = docs.withColumn("stats", statistics(F.col(text_column).cast("string")))
    n, chars = F.col("stats.w.n_words"), F.col("stats.w.word_chars")
    rate = lambda part, whole: (part / F.greatest(whole, F.lit(1))).cast("double")
    long = lambda column, name: F.col(column).cast("bigint").alias(name)
    return raw.withColumn(
        "stats",
        F.struct(
            long("stats.w.n_words", "n_words"),
            long("stats.w.word_chars", "word_chars"),
            long("stats.n_symbols", "n_symbols"),
            long("stats.l.n_dup_lines", "n_dup_lines"),
            long("stats.w.n_repeat_words", "n_repeat_words"),
            rate(F.col("stats.n_symbols"), n).alias("symbol_rate"),
            rate(chars, n).alias("mean_word"),
            rate(F.col("stats.l.n_dup_lines"), F.col("stats.l.n_lines")).alias("dup_line_rate"),
            rate(F.col("stats.w.n_repeat_words"), n).alias("repeat_rate"),
            rate(F.col("stats.n_bars"), n).alias("bar_rate"),
            rate(F.col("stats.n_digits"), chars).alias("digit_rate"),
            rate(F.col("stats.n_calls"), n).alias("call_rate"),
            n.cast("double").alias("size"),
        ),
    )


FEATURES = ("symbol_rate", "mean_word", "dup_line_rate", "repeat_rate", "bar_rate", "digit_rate", "call_rate", "size")


def base_failed(stats: Column) -> Column:
    """Fixed rule: fewer than 50 words, or over half of the words in repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Condition, ...]


def _all(rule: Rule, stats: Column) -> Column:
    held = F.lit(True)
    for condition in rule:
        held = held & condition.holds(stats)
    return held


def verdict(rules: list[Rule], stats: Column) -> Column:
    """False where a rule of the ordered list holds, else true."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(_all(rule, stats), False).otherwise(kept)
    return kept


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds of each statistic: the middles between neighbouring quantiles of both classes."""
    shares = [k / CUTS for k in range(CUTS + 1)]
    edges = rows.groupBy("bad").agg(*[F.percentile(f"stats.{name}", shares).alias(name) for name in FEATURES]).collect()
    cuts = {}
    for name in FEATURES:
        values = sorted({v for row in edges for v in row[name] or []})
        cuts[name] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return {name: values for name, values in cuts.items() if values}


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of the highest information gain on ``rows`` (columns stats, bad)."""
    def bin_of(name: str) -> Column:
        value = F.col(f"stats.{name}")
        return F.struct(F.lit(name).alias("feature"), F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda t: value >= t)).alias("bin"))

    bins = [bin_of(name) for name in cuts]
    counts: dict[str, list[list[int]]] = {name: [[0, 0] for _ in range(len(cuts[name]) + 1)] for name in cuts}
    table = rows.select("bad", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin", "bad").count()
    for row in table.collect():  # a row for each feature, bin and class
        counts[row["feature"]][row["bin"]][int(row["bad"])] = row["count"]
    best, most = None, 1e-9
    for name, by_bin in counts.items():
        good, bad = (sum(b[k] for b in by_bin) for k in (0, 1))
        if not bad or not good:
            continue
        below = [0, 0]
        for k, threshold in enumerate(cuts[name]):
            below = [below[0] + by_bin[k][0], below[1] + by_bin[k][1]]
            for above, (g, b) in ((False, below), (True, (good - below[0], bad - below[1]))):
                gain = b * (math.log(b / (b + g)) - math.log(bad / (bad + good))) if b else 0.0
                if gain > most:
                    best, most = Condition(name, above, threshold), gain
    return best


def _pruned(rule: Rule, rows: DataFrame) -> Rule:
    """The prefix of ``rule`` with the best balance on ``rows``, empty if none is precise enough."""
    sums = []
    for k in range(1, len(rule) + 1):
        held = _all(rule[:k], F.col("stats"))
        sums += [F.count_if(held & F.col("bad")), F.count_if(held & ~F.col("bad"))]
    found = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    best, most = (), -2.0
    for k in range(1, len(rule) + 1):
        bad, good = found[2 * k - 2], found[2 * k - 1]
        if bad >= LEAST_COVERED and bad >= PRECISION * (bad + good) and (bad - good) / (bad + good) > most:
            best, most = rule[:k], (bad - good) / (bad + good)
    return best


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> list[Rule]:
    """The ordered rules that reject; ``label_column`` is 0 for documents to reject. Starts jobs."""
    space = Workspace(docs.sparkSession)
    known = labels.select(F.col(id_column).alias("label_id"), F.col(label_column).alias("label")).where("label_id is not null and label is not null")
    known = known.groupBy("label_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE_ROWS)
    sample = docs.select(F.col(id_column).alias("label_id"), F.col(text_column).alias("own_text")).join(F.broadcast(known), "label_id")
    rows = described(sample, "own_text").select("stats", (F.col("label") == 0).alias("bad"), (F.pmod(F.xxhash64("label_id", F.lit("prune")), F.lit(3)) == 0).alias("prune"))
    rows = space.put(rows)
    cuts = _cuts(rows.where("not prune"))
    rules: list[Rule] = []
    while cuts and len(rules) < MAX_RULES:
        left = rows.where(verdict(rules, F.col("stats")))
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            condition = _best_condition(left.where(~F.col("prune") & _all(rule, F.col("stats"))), cuts)
            if condition is None or condition in rule:
                break
            rule += (condition,)
        kept = _pruned(rule, left.where("prune")) if rule else ()
        if not kept:
            break
        rules.append(kept)
    space.drop(rows)
    return rules


def judged(docs: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """``docs`` with ``stats``, ``base_failed`` and ``kept``."""
    rows = described(docs, text_column).withColumn("base_failed", base_failed(F.col("stats")))
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(rules, F.col("stats")))
