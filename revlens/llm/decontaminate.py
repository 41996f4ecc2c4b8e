"""Benchmark passages in documents, by SimHash windows, with DataFrame functions only.

A window has as many words as the benchmark item that it is compared with; a shorter text is one
window. For similarity ``t``, sets of ``a`` and ``b`` n-grams must share ``t * (a + b) / (1 + t)``
of them, so windows are laid at every start from which that many of a text's word 5-grams are
also in one item, in whatever order. No other window can reach ``t``.

Each window and item gets a 64-bit SimHash of its 5-grams, of which the second and later
occurrences count as n-grams of their own. The fingerprints are cut into ``RADIUS + 1`` blocks; two
within ``RADIUS`` bits agree in one block at least, so a join on (words, block, value) finds all of
them. Candidates within the radius are verified by the exact weighted similarity of their 5-grams,
sum of smaller counts over sum of larger counts.

Words are cut at white space and compared in lower case. Items with fewer than five words are one
n-gram, and so are the windows of their length: they match where a text has these words in a row.
Empty or NULL texts match nothing. Rows with the same id and
text give one row for each item, rows with the same id and another text their own. An empty
table on either side gives no rows. Only id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.native import let, shingles, words
from revlens.llm.store import Workspace

SIZE = 5
RADIUS = 23
BROADCAST_ROWS = 500_000  # of at most 40 bytes each


def _limits() -> list[tuple[int, int]]:
    """(first bit, bits) of each block."""
    count = RADIUS + 1
    edges = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def simhash(grams: Column) -> Column:
    """Bit b is set if more n-grams have it than have not."""
    lean = lambda b: F.aggregate(grams, F.lit(0), lambda n, g: n + F.when(F.getbit(g, b) == 1, 1).otherwise(-1))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(lean(b) > 0, F.expr("1L")).otherwise(F.expr("0L")))
    return let(bits, lambda values: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.expr("0L"), lambda h, b: h.bitwiseOR(F.call_function("shiftleft", F.get(values, b), b))))


def blocks(fingerprint: Column) -> Column:
    """(block number, value) of every block."""
    parts = [F.struct(F.lit(k).alias("no"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << n) - 1).cast("bigint")).alias("value")) for k, (a, n) in enumerate(_limits())]
    return F.array(*parts)


def counted(grams: Column) -> Column:
    """A multiset as a set: each n-gram with the number of its occurrence."""
    return let(F.array_sort(grams), lambda s: F.transform(s, lambda g, i: F.xxhash64(g, i - F.array_position(s, g))))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a stored table of few narrow rows; a larger one is joined by shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _printed(grams: Column) -> Column:
    """(multiset, print) of n-grams."""
    return let(counted(grams), lambda s: F.struct(s.alias("multiset"), simhash(s).alias("print")))


def _needed(grams: Column, similarity: float) -> Column:
    """How many n-grams two multisets of ``grams`` n-grams in all must share to be similar."""
    return F.greatest(F.lit(1), F.ceil(grams * similarity / (1 + similarity) - 1e-9).cast("int"))


def _starts() -> Column:
    """Starts of the windows of ``a`` n-grams that hold ``need`` of the ascending places ``at``."""

    def around(i: Column) -> Column:
        first = F.greatest(F.lit(0), F.get("at", i + F.col("need") - 1) - F.col("a") + 1)
        last = F.least(F.get("at", i), F.col("g") - F.col("a"))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")), around)))


def _in_a_row(keyed: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """Where the texts first have all ``length`` words of an item that is one n-gram."""
    wanted = _small(items.select("n", "passage", F.col("grams")[0].alias("gram")).distinct())
    own = keyed.select("doc_id", "text_key", words(F.lower("text")).alias("w")).where(F.size("w") >= length)
    hits = own.select("doc_id", "text_key", F.posexplode(shingles(F.col("w"), length)).alias("at", "gram")).join(wanted, "gram")
    first = hits.groupBy("doc_id", "text_key", "n", "passage").agg(F.min("at").cast("bigint").alias("start"))
    return first.select("doc_id", "text_key", "n", "passage", F.lit(1.0).alias("similarity"), "start", F.col("n").cast("bigint").alias("n_words"))


def matches(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start, n_words): each text's best window for each item.

    text_key is ``xxhash64`` of the text. start is the window's first word, counted from 0; n_words its length. Starts jobs.
    """
    space = Workspace(docs.sparkSession)
    items = benchmark.select(F.col(item_id).alias("item_id"), words(F.lower(F.col(item_text).cast("string"))).alias("w")).where("size(w) > 0")
    items = items.select("item_id", F.size("w").alias("n"), shingles(F.col("w"), SIZE).alias("grams"))
    items = space.put(items.select("*", F.xxhash64("grams").alias("passage")))
    passages = space.put(items.where(F.col("n") >= SIZE).dropDuplicates(["n", "passage"]).select("n", "passage", "grams", _printed(F.col("grams")).alias("own")))
    places = passages.select("n", "passage", F.size("grams").alias("m"), F.explode(F.array_distinct("grams")).alias("gram"))
    places = _small(space.put(places))

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("text is not null")
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    own = keyed.select("doc_id", "text_key", shingles(words(F.lower("text")), SIZE).alias("grams")).select("*", F.size("grams").alias("g"))
    hits = own.select("doc_id", "text_key", "g", F.posexplode("grams").alias("at", "gram")).join(places, "gram")
    held = hits.groupBy("doc_id", "text_key", "n", "passage").agg(F.sort_array(F.collect_set("at")).alias("at"), F.max("g").alias("g"), F.max("m").alias("m"))
    held = held.withColumn("a", F.least("g", "m")).withColumn("need", _needed(F.col("a") + F.col("m"), similarity)).where("size(at) >= need")
    laid = space.put(held.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n", F.explode(_starts()).alias("start")).distinct())
    by_text = laid.groupBy("d", "k").agg(F.collect_list(F.struct("n", "start")).alias("places"))
    by_text = F.broadcast(by_text) if laid.count() <= BROADCAST_ROWS else by_text
    met = keyed.join(by_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    met = met.select("doc_id", "text_key", "places", shingles(words(F.lower("text")), SIZE).alias("grams"))
    met = met.select("doc_id", "text_key", "grams", F.explode("places").alias("place"))
    inside = F.slice("grams", F.col("place.start") + 1, F.least(F.col("place.n") - SIZE + 1, F.size("grams")))
    windows = met.select("doc_id", "text_key", "place.n", "place.start", inside.alias("grams")).dropDuplicates(["doc_id", "text_key", "n", "start"])
    n_words = (F.size("grams") + SIZE - 1).alias("n_words")
    windows = space.put(windows.select("doc_id", "text_key", "n", "start", n_words, _printed(F.col("grams")).alias("own")))
    windows = windows.select("doc_id", "text_key", "n", "start", "n_words", "own.print", "own.multiset")

    index = passages.select("n", "passage", F.col("own.print").alias("item_print"), F.explode(blocks(F.col("own.print"))).alias("block"))
    probes = windows.select("doc_id", "text_key", "n", "start", "n_words", "print", F.explode(blocks(F.col("print"))).alias("block"))
    near = (
        probes.join(_small(space.put(index)), ["n", "block"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("doc_id", "text_key", "n", "start", "n_words", "passage")
        .distinct()
    )
    left = near.select(F.col("doc_id").alias("d"), "text_key", "n", "start", "n_words", "passage")
    same = F.col("doc_id").eqNullSafe(F.col("d"))
    pairs = left.join(windows, ["text_key", "n", "start", "n_words"]).where(same)
    pairs = pairs.join(passages.select("passage", "n", F.col("own.multiset").alias("item_multiset")), ["passage", "n"])
    both = F.size(F.array_intersect("multiset", "item_multiset"))
    scored = pairs.withColumn("similarity", both / (F.size("multiset") + F.size("item_multiset") - both)).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words")).alias("best")
    found = scored.groupBy("doc_id", "text_key", "n", "passage").agg(best).select(
        "doc_id", "text_key", "n", "passage", "best.similarity", (-F.col("best.s")).cast("bigint").alias("start"), F.col("best.n_words").cast("bigint").alias("n_words")
    )
    for length in [row["n"] for row in items.where(F.col("n") < SIZE).select("n").distinct().collect()]:  # SIZE - 1 at most
        found = found.union(_in_a_row(keyed, items.where(F.col("n") == length), length))
    found = found.join(items.select("item_id", "n", "passage").distinct(), ["n", "passage"])
    return found.select("doc_id", "text_key", "item_id", "similarity", "start", "n_words")
