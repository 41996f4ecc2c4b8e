"""Samples that depend on the rows' content and the seed only, not on the layout of the data.

Rows are ordered by a digest. To find the n-th one, rows are counted per bucket of the order,
and the bucket in which the n-th row falls is split again until it is taken whole; no task or
driver ever sorts or holds the n rows. Rows that are equal in every column have one digest, and
any of them may be taken. An exact sample reads its input twice: to count it, and to store the
rows below a bound that is slightly over the wanted share; the exact cut is made among those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.session import materialise

_BUCKETS = 65_536
_PREFIX = 4
_DIGEST = 64
_BOUND = 12  # hexadecimal letters that the bound is compared by
_DRAWN = 15  # hexadecimal letters that a random number is taken from
_PIECE = 100_000  # numbers in a piece, at most
_FEW = 100_000  # digests of this size that are broadcast, at most


def hash_text(keys: list[str], seed: int) -> Column:
    """Hexadecimal digest of the key and the seed: the random order of the rows."""
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))))


def _order(rows: DataFrame, keys: list[str], seed: int) -> Column:
    """The digest of the key, and for equal keys that of the row."""
    content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns))))
    return F.concat(hash_text(keys, seed), F.md5(content))


def _bucket_of_nth(rows: DataFrame, bucket: Column, n: int) -> tuple:
    """Bucket of the ``n``-th row, its size, and the number of rows before it.

    The window runs over at most ``_BUCKETS`` rows and one row reaches the driver.
    """
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.orderBy("bucket"))
    first = counts.withColumn("up_to", up_to).filter(F.col("up_to") >= n).orderBy("bucket").first()
    return first.bucket, first.n, first.up_to - first.n


def _first_by_order(ordered: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by the digest in ``_order``, of at least ``n``."""
    order, inside, left, prefix = F.col("_order"), ordered, n, ""
    while len(prefix) < _DIGEST:
        bucket = F.substring(order, len(prefix) + 1, _PREFIX)
        letters, size, earlier = _bucket_of_nth(inside, bucket, left)
        left -= earlier
        prefix += letters
        if left == size:
            return ordered.filter(F.substring(order, 1, len(prefix)) <= prefix)
        inside = ordered.filter(order.startswith(prefix))
    return ordered.filter(order < prefix).unionByName(inside.limit(left))  # of equal rows


def _first_by_number(rows: DataFrame, n: int, order_key: str) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows that are surely among the first ``n`` by a whole-number key, the rest's candidates, how many of them)."""
    key = F.col(order_key)
    known = rows.filter(key.isNotNull())
    low, high, size = known.agg(F.min(key), F.max(key), F.count(key)).first()
    if n <= 0 or not size:
        return known.filter(F.lit(False)), None, 0
    inside, left = known, n
    while left < size and high > low:
        width = -(-(high - low + 1) // _BUCKETS)
        bucket = F.expr(f"CAST(`{order_key}` - {low}L AS BIGINT) div {width}L")
        number, size, earlier = _bucket_of_nth(inside, bucket, left)
        left -= earlier
        low += number * width
        high = min(high, low + width - 1)
        inside = known.filter(key.between(low, high))
    if left >= size:
        return known.filter(key <= high), None, 0
    return known.filter(key < low), inside, left


def head_n(rows: DataFrame, n: int, order_key: str) -> DataFrame:
    """The first ``n`` rows by a whole-number key, in order (starts jobs).

    Rows without a key are left out. Of equal keys those with the smaller digest come first.
    """
    sure, ties, left = _first_by_number(rows, n, order_key)
    if ties is not None:
        sure = sure.unionByName(_first_by_order(ties.withColumn("_order", _order(rows, [order_key], 0)), left).drop("_order"))
    return sure.orderBy(order_key)


def sample_exact(rows: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows without replacement, in no order (starts jobs).

    ``keys`` decide the draw, then the rest of the row. Fails if there are fewer than ``n`` rows.
    """
    if n <= 0:
        return rows.limit(0)
    return _drawn(rows.withColumn("_order", _order(rows, keys, seed)), n, rows.count()).drop("_order")


def _places(spark: SparkSession, total: int, k: int, seed: int) -> DataFrame:
    """``k`` different random numbers below ``total``, of which they are at most half (starts jobs).

    Numbers are drawn one after the other from a digest, and those drawn before don't count.
    """
    if not k:
        return spark.range(0).select(F.col("id").alias("place"))
    draws = int(1.4 * k + 6 * k**0.5 + 50)
    while True:
        number = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))), 1, _DRAWN), 16, 10)
        drawn = spark.range(draws).select((number.cast("bigint") % F.lit(total)).alias("place"), F.col("id").alias("draw"))
        first = materialise(drawn.groupBy("place").agg(F.min("draw").alias("draw")))
        if first.count() >= k:
            return _first_by_number(first, k, "draw")[0].select("place")
        draws *= 2


def sample_counted(counted: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``code``, one row for each of ``n`` random copies of counted contents (starts jobs).

    Takes ``code`` (a hexadecimal digest, each once) and ``copies``. All copies of all contents
    are numbered in the order of the codes: the sums for each beginning of a code split the
    numbers among the beginnings, and running sums split them inside. The drawn numbers then
    fall into the contents' ranges. So a content costs a row or a few, however many copies it
    has, and a drawn copy one. If more than half are wanted, those left out are drawn. Ranges
    and numbers meet in pieces that hold about one number each. Numbers are taken modulo the
    total from 60 bits. Fails if there are fewer than ``n`` copies.
    """
    spark = counted.sparkSession
    start = F.substring("code", 1, _PREFIX)
    sums = counted.groupBy(start.alias("_start")).agg(F.sum("copies").alias("n"))
    up_to = Window.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    begins = materialise(sums.select("_start", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("_begin"), "n"))
    total = begins.agg(F.sum("n")).first()[0] or 0
    if total < n:
        raise ValueError(f"asked for {n} rows, but there are only {total}")
    left_out = n > total - n
    k = total - n if left_out else n
    inside = Window.partitionBy("_start").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each of the 65,536 beginnings at most, so they are broadcast.
    numbered = (
        counted.withColumn("_start", start)
        .withColumn("_before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(F.broadcast(begins.drop("n")), "_start")
        .select("code", (F.col("_begin") + F.col("_before")).alias("first"), (F.col("_begin") + F.col("_before") + F.col("copies") - 1).alias("last"))
    )
    width = max(1, min(total // max(k, 1), _PIECE))
    wide = width * _BUCKETS
    coarse = numbered.select("*", F.explode(F.sequence(F.expr(f"first div {wide}L"), F.expr(f"last div {wide}L"))).alias("_wide"))
    low, high = F.greatest("first", F.col("_wide") * wide), F.least("last", F.col("_wide") * wide + (wide - 1))
    within = coarse.select("code", low.alias("first"), high.alias("last"))
    fine = within.select("*", F.explode(F.sequence(F.expr(f"first div {width}L"), F.expr(f"last div {width}L"))).alias("piece"))
    low, high = F.greatest("first", F.col("piece") * width), F.least("last", F.col("piece") * width + (width - 1))
    pieces = fine.select("code", "piece", low.alias("first"), high.alias("last"))
    places = _places(spark, total, k, seed)
    if left_out:
        each = pieces.select("code", F.explode(F.sequence("first", "last")).alias("place"))
        return each.join(places, "place", "left_anti").select("code")
    met = pieces.join(places.withColumn("piece", F.expr(f"place div {width}L")), "piece")
    return met.filter(F.col("place").between(F.col("first"), F.col("last"))).select("code")


def sample_repeated(rows: DataFrame, n: int, places: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows of a table in which rows may be equal but for their ``places``.

    Each of several equal rows is drawn for itself. They are counted per content, and those
    drawn get the smallest of their places. Fails if there are fewer than ``n`` rows (starts
    jobs). Reads ``rows`` twice: to count digests, and to find the contents of those drawn,
    which are few enough to be broadcast below ``_FEW``; beyond, equal rows are put together
    first and meet the digests drawn in a join.
    """
    if n <= 0:
        return rows.limit(0)
    content = [c for c in rows.columns if c not in places]
    coded = rows.withColumn("_code", F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in content)))))
    counted = materialise(coded.groupBy(F.col("_code").alias("code")).agg(F.count(F.lit(1)).alias("copies")))
    drawn = materialise(sample_counted(counted, n, seed).withColumnRenamed("code", "_code"))
    codes = drawn.distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in [*places, *content]))
    if n <= _FEW:
        first = coded.join(F.broadcast(codes), "_code").groupBy("_code").agg(F.min(row).alias("_row"))
    else:
        first = coded.groupBy("_code").agg(F.min(row).alias("_row")).join(codes, "_code", "left_semi")
    return drawn.join(first, "_code").select(*(F.col(f"_row.`{c}`").alias(c) for c in rows.columns))


def _drawn(ordered: DataFrame, n: int, total: int) -> DataFrame:
    """The first ``n`` of ``total`` rows by ``_order``, from a stored part that is slightly larger."""
    if total < n:
        raise ValueError(f"asked for {n} rows, but there are only {total}")
    wanted = n + 6 * n**0.5 + 50
    while True:
        bound = int(min(1.0, wanted / total) * 16**_BOUND)
        below = F.substring("_order", 1, _BOUND) < f"{bound:0{_BOUND}x}" if bound < 16**_BOUND else F.lit(True)
        near = materialise(ordered.filter(below))
        if near.count() >= n:
            return _first_by_order(near, n)
        wanted *= 2


def sample_fraction(
    rows: DataFrame, fraction: float, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Each row with probability ``fraction``.

    With ``keys`` the choice depends on the key only; without, on the row's position.
    """
    if keys is None:
        return rows.sample(False, fraction, seed)
    if fraction >= 1.0:
        return rows
    limit = f"{int(fraction * 16**8):08x}"
    return rows.filter(F.substring(hash_text(keys, seed), 1, 8) < limit)
